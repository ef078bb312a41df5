"""Queries over orders, confirmations, movements and their histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclelake.operators import orders as o
from cyclelake.plans.checks import sql

AS_OF = "2001-09-01 00:00:00"


def found_and_missing(lake):
    """Look up the orders named by the movements and report every key with a found flag."""
    found, missing = o.lookup(lake.view("br_movements"), lake.orders(), "order_id")
    return found.select("order_id", F.lit(True).alias("found")).unionByName(
        missing.select("order_id", F.lit(False).alias("found"))
    )


def material_lookup(lake):
    keys = lake.orders().select(F.col("material_id")).unionByName(
        lake.orders().select(F.concat("material_id", F.lit("-old")).alias("material_id"))
    )
    found, missing = o.lookup(keys, lake.materials(), "material_id")
    return found.select("material_id", F.lit(True).alias("found")).unionByName(
        missing.select("material_id", F.lit(False).alias("found"))
    )


def pending_orders(lake):
    """Versions before confirmation or abort, i.e. what the ERP knew before."""
    return lake.view("br_orders").filter(F.col("status").isin("CREATED", "RELEASED", "IN_PROGRESS"))


def applied(lake):
    from cyclelake.operators.silver import silver_orders

    history = pending_orders(lake)
    audited = o.confirmation_audit(lake.view("br_confirmations"), history)
    return o.apply_confirmations(silver_orders(history), audited).select(
        "order_id", "status", "operator_id", "actual_start", "actual_end", "sap_confirmation_number", "updated_at"
    )


def merged(lake):
    local = lake.orders().filter("status = 'CONFIRMED'").withColumn("status", F.lit("closed"))
    return o.merge_keep_local(local, lake.orders())


def late_orders(lake):
    extensions = lake.orders().filter("plant = 'kirchheim'").select(
        "order_id", F.lit(60 * 24 * 700).alias("extension_minutes")
    )
    return o.timeouts(lake.orders(), lake.materials(), AS_OF, extensions)


def at_confirmation(lake):
    rows = lake.view("br_confirmations").select("order_id", "posted_at", "final_moisture_ppm").join(
        lake.orders().select("order_id", "material_id"), "order_id", "left"
    ).join(lake.materials().select("material_id", "target_moisture_ppm"), "material_id", "left").join(
        lake.order_state().select("order_id", "quality_check_passed"), "order_id", "left"
    )
    return rows.select("order_id", "posted_at", o.spec_met_at_confirmation().alias("spec_met"))


AUDIT = """select c.*, k.order_id is not null as known, (select arg_max(status, updated_at) from br_orders h
    where h.order_id = c.order_id and h.updated_at < c.posted_at) as status_before
  from br_confirmations c left join (select distinct order_id from br_orders) k on k.order_id = c.order_id"""
STEPS = """select order_id, status, updated_at, lag(status) over (partition by order_id order by updated_at, status)
  as from_status from (select distinct order_id, status, updated_at from br_orders)"""
ALLOWED = """select * from (values ('CREATED','RELEASED'),('CREATED','ABORTED'),('RELEASED','IN_PROGRESS'),
  ('RELEASED','ABORTED'),('IN_PROGRESS','CONFIRMED'),('IN_PROGRESS','ABORTED'),('CONFIRMED','CLOSED'))
  t(from_status, to_status)"""
NUMBERS = r"""select split_part(doc, '-', 1) as kind, cast(split_part(doc, '-', 2) as int) as year,
  cast(split_part(doc, '-', 3) as bigint) as number, count(*) as n_documents from
  (select document_number as doc from br_movements union all
   select sap_confirmation_number from br_confirmations where sap_confirmation_number is not null) group by all"""
OPEN_RUNS = """select p.order_id, o.oven_id, p.cycle_start_time, p.cycle_end_time,
  max(coalesce(p.cycle_end_time, timestamp '9999-12-31')) over (partition by o.oven_id
    order by p.cycle_start_time, p.order_id rows between unbounded preceding and 1 preceding) as busy_until
  from s_pairs p join s_orders o on p.order_id = o.order_id where p.cycle_start_time is not null"""

QUERIES = {
    "list_orders": (
        lambda lake: o.list_orders(lake.orders(), "confirmed", "regensburg").select("order_id", "status", "plant", "oven_id"),
        sql("select order_id, status, plant, oven_id from s_orders where status = 'CONFIRMED' and plant = 'regensburg'"),
    ),
    "order_lookup": (
        found_and_missing,
        sql("""select distinct m.order_id, o.order_id is not null as found from br_movements m
  left join s_orders o on m.order_id = o.order_id"""),
    ),
    "material_lookup": (
        material_lookup,
        sql("""select k.material_id, m.material_id is not null as found from
  (select distinct material_id from s_orders union select material_id || '-old' from s_orders) k
  left join s_materials m on k.material_id = m.material_id"""),
    ),
    "orders_with_spec": (
        lambda lake: o.orders_with_spec(lake.orders(), lake.materials()).select(
            "order_id", "status", "material_id", "material_description", "target_moisture_ppm", "standard_cycle_minutes"
        ),
        sql("""select order_id, status, o.material_id, material_description, target_moisture_ppm, m.standard_cycle_minutes
  from s_orders o left join s_materials m on o.material_id = m.material_id"""),
    ),
    "audit_transitions": (
        lambda lake: o.audit_transitions(lake.view("br_orders")),
        sql("""select order_id, from_status, status as to_status, updated_at from steps where from_status is not null and
  not exists (select 1 from allowed a where a.from_status = steps.from_status and a.to_status = steps.status)""",
            steps=STEPS, allowed=ALLOWED),
    ),
    "order_state_from_events": (
        lambda lake: o.order_state_from_events(lake.events()),
        sql("""select order_id, case event_type when 'cycle_started' then 'in-progress' when 'cycle_confirmed' then 'closed'
  when 'cycle_aborted' then 'ABORTED' when 'cycle_timeout' then 'TIMEOUT' else 'CONFIRM_FAILED' end as status,
  event_time as since from s_events
  qualify row_number() over (partition by order_id order by event_time desc, event_id desc) = 1"""),
    ),
    "confirmation_audit": (
        lambda lake: o.confirmation_audit(lake.view("br_confirmations"), lake.view("br_orders")).select(
            "order_id", "posted_at", "status_before", "outcome"
        ),
        sql("""select order_id, posted_at, status_before, case when not known then 'not_found'
  when ok and row_number() over (partition by order_id, ok order by posted_at) = 1 then 'ok'
  when ok or status_before = 'CONFIRMED' then 'already_confirmed' else 'invalid_status' end as outcome
  from (select *, coalesce(status_before in ('IN_PROGRESS', 'RELEASED'), false) as ok from audit)""", audit=AUDIT),
    ),
    "apply_confirmations": (
        applied,
        sql("""select p.order_id, case when c.order_id is not null then 'CONFIRMED' else p.status end as status,
  case when c.order_id is not null then c.operator_id else p.operator_id end as operator_id,
  case when c.order_id is not null then c.actual_start else p.actual_start end as actual_start,
  case when c.order_id is not null then c.actual_end else p.actual_end end as actual_end,
  coalesce(c.sap_confirmation_number, p.sap_confirmation_number) as sap_confirmation_number,
  coalesce(c.posted_at, p.updated_at) as updated_at
  from (select * from pending qualify row_number() over (partition by order_id order by updated_at desc, ingested_at desc) = 1) p
  left join (select * from br_confirmations
    qualify row_number() over (partition by order_id order by posted_at) = 1) c on c.order_id = p.order_id""",
            pending="select * from br_orders where status in ('CREATED', 'RELEASED', 'IN_PROGRESS')"),
    ),
    "flag_goods_movement": (
        lambda lake: o.flag_goods_movement(lake.orders(), lake.view("br_movements")).select(
            "order_id", "status", "goods_movement_posted"
        ),
        sql("""select order_id, status, order_id in (select order_id from br_movements) as goods_movement_posted
  from s_orders"""),
    ),
    "movements_of_orders": (
        lambda lake: o.movements_of(lake.view("br_movements"), lake.orders().filter("plant = 'regensburg'")),
        sql("select * from br_movements where order_id in (select order_id from s_orders where plant = 'regensburg')"),
    ),
    "merge_keep_local": (
        merged,
        sql("""select order_id, material_id, plant, oven_id,
  case when status = 'CONFIRMED' then 'closed' else 'released' end as status from s_orders"""),
    ),
    "spec_met_at_confirmation": (
        at_confirmation,
        sql("""select c.order_id, c.posted_at, q.quality_check_passed and
  (m.target_moisture_ppm is null or c.final_moisture_ppm < m.target_moisture_ppm) as spec_met
  from br_confirmations c left join s_orders o on o.order_id = c.order_id
  left join s_materials m on m.material_id = o.material_id left join order_state q on q.order_id = c.order_id"""),
    ),
    "timeouts": (
        late_orders,
        sql(f"""select * from (select o.order_id, o.oven_id, o.material_id,
  (epoch_us(timestamp '{AS_OF}') - epoch_us(actual_start)) / 6e7 as elapsed_minutes,
  cast(max_cycle_minutes + case when plant = 'kirchheim' then 1008000 else 0 end as bigint) as allowed_minutes,
  (epoch_us(timestamp '{AS_OF}') - epoch_us(actual_start)) / 6e7 - max_cycle_minutes
    - case when plant = 'kirchheim' then 1008000 else 0 end as minutes_over
  from s_orders o join s_materials m on m.material_id = o.material_id
  where status = 'IN_PROGRESS' and actual_start is not null) where minutes_over > 0"""),
    ),
    "order_counts": (
        lambda lake: o.order_counts(lake.orders()),
        sql("select status, count(*) as n_orders from s_orders group by status"),
    ),
    "incomplete_cycles": (
        lambda lake: o.incomplete_cycles(lake.events(), lake.orders()),
        sql("""select * from (select coalesce(e.order_id, o.order_id) as order_id, status, started_at, confirmed_at,
  case when confirmed_at is not null and started_at is null then 'confirmed_without_start'
    when confirmed_at < started_at then 'end_before_start'
    when started_at is not null and confirmed_at is null and aborted_at is null then 'started_without_end'
    when status = 'CONFIRMED' and confirmed_at is null and started_at is null then 'confirmed_without_events' end as reason
  from (select order_id, min(event_time) filter (where event_type = 'cycle_started') as started_at,
    max(event_time) filter (where event_type = 'cycle_confirmed') as confirmed_at,
    max(event_time) filter (where event_type = 'cycle_aborted') as aborted_at from s_events group by order_id) e
  full join s_orders o on e.order_id = o.order_id) where reason is not null"""),
    ),
    "document_numbers": (
        lambda lake: o.document_numbers(
            lake.view("br_movements").select(F.col("document_number").alias("doc")).unionByName(
                lake.view("br_confirmations").select(F.col("sap_confirmation_number").alias("doc"))
            ), "doc",
        ),
        sql("""select kind, year, 'gap' as issue, previous + 1 as first_number, number - 1 as last_number,
  number - previous - 1 as n from (select *, lag(number) over (partition by kind, year order by number) as previous
    from numbers) where number - previous > 1
  union all select kind, year, 'duplicate', number, number, n_documents from numbers where n_documents > 1""",
            numbers=NUMBERS),
    ),
    "overlapping_cycles": (
        lambda lake: o.overlapping_cycles(lake.pairs().select("order_id", "cycle_start_time", "cycle_end_time").join(
            lake.orders().select("order_id", "oven_id"), "order_id"
        )),
        sql("""select order_id, oven_id, cycle_start_time, cycle_end_time, busy_until from open_runs
  where busy_until > cycle_start_time""", open_runs=OPEN_RUNS),
    ),
}
