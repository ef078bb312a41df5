"""Queries over the historian and the oven state."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclelake.operators import state as st
from cyclelake.plans.checks import sql

AS_OF = "2024-01-31 00:00:00"
ARRIVAL = "timestamp_opc, timestamp_mqtt, reading_id"
NEWEST = "timestamp_opc desc, timestamp_mqtt desc, reading_id desc"

LATEST = f"""select * from ad_live
  qualify row_number() over (partition by oven_id, sensor_type order by {NEWEST}) = 1"""
EDGES = f"""select oven_id, order_id, timestamp_opc, timestamp_mqtt, reading_id,
  lag(order_id) over (partition by oven_id order by {ARRIVAL}) as previous_order from ad_live"""
ISLANDS = f"""select *, sum(case when order_id is null then 1 else 0 end) over
  (partition by oven_id order by {ARRIVAL} rows unbounded preceding) as island from ad_live"""
RUNS = """select oven_id, island, min(timestamp_opc) as run_start, max(timestamp_opc) as run_end,
  count(distinct order_id) as n_orders, count(*) as n_readings
  from islands where order_id is not null group by oven_id, island"""
CURRENT = f"""select a.oven_id, a.order_id, a.last_seen, t.value as "temperature_degC", v.value as vacuum_mbar,
  m.value as moisture_ppm, case when a.order_id is not null then r.run_start end as cycle_start
  from (select oven_id, order_id, timestamp_opc as last_seen from ad_live
    qualify row_number() over (partition by oven_id order by {NEWEST}) = 1) a
  left join latest t on t.oven_id = a.oven_id and t.sensor_type = 'temperature'
  left join latest v on v.oven_id = a.oven_id and v.sensor_type = 'vacuum'
  left join latest m on m.oven_id = a.oven_id and m.sensor_type = 'moisture'
  left join (select oven_id, max(run_start) as run_start from runs group by oven_id) r on r.oven_id = a.oven_id"""
STATE = f"""select oven_id, order_id, case when order_id is null then 'idle'
  when round((epoch_us(timestamp '{AS_OF}') - epoch_us(cycle_start)) / 6e7, 2) >= 2160 then 'timeout'
  when moisture_ppm < 50 then 'cycle_complete' else 'running' end as status,
  round("temperature_degC", 2) as "temperature_degC", round(vacuum_mbar, 2) as vacuum_mbar,
  round(moisture_ppm, 2) as moisture_ppm,
  round((epoch_us(timestamp '{AS_OF}') - epoch_us(cycle_start)) / 6e7, 2) as cycle_elapsed_minutes,
  moisture_ppm < 50 as moisture_threshold_met, timestamp '{AS_OF}' as "timestamp" from current_ovens"""
PARTS = {"latest": LATEST, "edges": EDGES, "islands": ISLANDS, "runs": RUNS, "current_ovens": CURRENT,
         "oven_state": STATE}

# Newest stretch of one order per oven, over the order-stamped readings.
LAST_STRETCH = f"""select oven_id, reading_id, order_id, sensor_type, value, timestamp_opc, timestamp_mqtt,
  first_value(order_id) over (partition by oven_id order by {NEWEST}) as active from s_readings"""
STRETCH_ROWS = f"""select *, sum(case when order_id <> active then 1 else 0 end) over
  (partition by oven_id order by {NEWEST} rows unbounded preceding) as others from stretch"""
PER_MATERIAL = """select c.oven_id, c.order_id, c.cycle_start, c.last_seen, t.value as "temperature_degC",
  v.value as vacuum_mbar, m.value as moisture_ppm, target_moisture_ppm, max_cycle_minutes from
  (select oven_id, any_value(active) as order_id, min(case when others = 0 then timestamp_opc end) as cycle_start,
    max(timestamp_opc) as last_seen from stretch_rows group by oven_id) c
  left join newest_silver t on t.oven_id = c.oven_id and t.sensor_type = 'temperature'
  left join newest_silver v on v.oven_id = c.oven_id and v.sensor_type = 'vacuum'
  left join newest_silver m on m.oven_id = c.oven_id and m.sensor_type = 'moisture'
  left join s_orders o on o.order_id = c.order_id left join s_materials x on x.material_id = o.material_id"""


def requested_ovens(lake):
    """Every oven of the live table and the next number after each, so that some have no data."""
    number = F.substring("oven_id", 6, 2).cast("int")
    ovens = lake.view("ad_live").select("oven_id", number.alias("n")).distinct()
    return ovens.select(F.explode(F.array(
        F.col("oven_id"), F.concat(F.lit("oven-"), F.lpad((F.col("n") + 20).cast("string"), 2, "0"))
    )).alias("oven_id"))


def phases(lake):
    return st.cycle_phase(
        lake.readings(), lake.pairs(), lake.orders(), lake.materials(), hot=lake.hot_orders()
    ).select(
        "reading_id", "order_id", "elapsed_minutes", "phase"
    )


def responses(lake):
    answer = st.historian_response(lake.readings())
    return answer.select(
        "order_id", F.col("count").alias("n"),
        F.array_join(F.transform("readings", lambda r: F.concat_ws(
            ":", r.reading_id.cast("string"), r.sensor_type, r.quality)), ",").alias("items"),
    )


def per_material(lake):
    return st.process_state_per_material(
        lake.readings(), lake.orders(), lake.materials(), as_of=F.col("last_seen")
    )


QUERIES = {
    "latest_per_channel": (lambda lake: st.latest_per_channel(lake.view("ad_live")), sql("select * from latest", **PARTS)),
    "latest_good_per_channel": (
        lambda lake: st.latest_per_channel(lake.view("ad_live"), good_only=True),
        sql(f"""select * from ad_live where quality = 'Good'
  qualify row_number() over (partition by oven_id, sensor_type order by {NEWEST}) = 1"""),
    ),
    "retain_last_n": (
        lambda lake: st.retain_last_n(lake.view("ad_live"), 100).select("oven_id", "sensor_type", "reading_id", "value"),
        sql(f"""select oven_id, sensor_type, reading_id, value from ad_live
  qualify row_number() over (partition by oven_id, sensor_type order by {NEWEST}) <= 100"""),
    ),
    "historian_query": (
        lambda lake: st.historian_query(
            lake.view("ad_live"), "500-3", "oven-03", from_ts="2024-01-01 00:00:00", to_ts="2024-01-20 00:00:00"
        ),
        sql("""select * from ad_live where order_id = '500-3' and oven_id = 'oven-03' and timestamp_opc between
  timestamp '2024-01-01 00:00:00' and timestamp '2024-01-20 00:00:00' order by timestamp_opc, reading_id limit 1000"""),
    ),
    "historian_response": (
        responses,
        sql("""select order_id, cast(count(*) as int) as n,
  string_agg(cast(reading_id as string) || ':' || sensor_type || ':' || quality, ',' order by timestamp_opc, reading_id)
    as items from (select * from s_readings
    qualify row_number() over (partition by order_id order by timestamp_opc, reading_id) <= 1000) group by order_id"""),
    ),
    "active_order": (
        lambda lake: st.active_order(lake.view("ad_live")),
        sql(f"""select oven_id, order_id from ad_live
  qualify row_number() over (partition by oven_id order by {NEWEST}) = 1"""),
    ),
    "cycle_edges": (
        lambda lake: st.cycle_edges(lake.view("ad_live")),
        sql("""select *, case when previous_order is null then 'start' else 'end' end as edge from edges
  where (previous_order is null) <> (order_id is null)""", **PARTS),
    ),
    "cycle_edges_on_change": (
        lambda lake: st.cycle_edges(lake.view("ad_live"), restart_on_change=True),
        sql("""select *, case when order_id is not null then 'start' else 'end' end as edge from edges
  where previous_order is distinct from order_id""", **PARTS),
    ),
    "cycle_runs": (
        lambda lake: st.cycle_runs(lake.view("ad_live")),
        sql("""select oven_id, run_start, run_end, n_orders, n_readings,
  row_number() over (partition by oven_id order by run_start, run_end) as run_number from runs""", **PARTS),
    ),
    "cycle_elapsed_minutes": (
        lambda lake: st.cycle_elapsed_minutes(lake.view("ad_live"), AS_OF),
        sql(f"""select oven_id, order_id, round((epoch_us(timestamp '{AS_OF}') - epoch_us(cycle_start)) / 6e7, 2)
  as cycle_elapsed_minutes from current_ovens""", **PARTS),
    ),
    "moisture_threshold_met": (
        lambda lake: st.moisture_threshold_met(lake.view("ad_live"), 50.0),
        sql("""select o.oven_id, value as moisture_ppm, value < 50 as moisture_threshold_met
  from (select distinct oven_id from ad_live) o left join latest l
  on l.oven_id = o.oven_id and sensor_type = 'moisture'""", **PARTS),
    ),
    "oven_status": (
        lambda lake: st.oven_status(lake.view("ad_live"), 50.0, 2160.0, AS_OF),
        sql("select oven_id, status from oven_state", **PARTS),
    ),
    "process_state": (
        lambda lake: st.process_state(lake.view("ad_live"), 50.0, 2160.0, AS_OF, ovens=requested_ovens(lake)),
        sql(f"""select * from oven_state union all
  select distinct 'oven-' || lpad(cast(cast(substr(oven_id, 6, 2) as int) + 20 as string), 2, '0'), null, 'idle', null,
  null, null, null, null, timestamp '{AS_OF}' from ad_live""", **PARTS),
    ),
    "process_state_per_material": (
        per_material,
        sql("""select oven_id, order_id, case when round((epoch_us(last_seen) - epoch_us(cycle_start)) / 6e7, 2)
    >= max_cycle_minutes then 'timeout' when moisture_ppm < target_moisture_ppm then 'cycle_complete'
    else 'running' end as status, round("temperature_degC", 2) as "temperature_degC",
  round(vacuum_mbar, 2) as vacuum_mbar, round(moisture_ppm, 2) as moisture_ppm,
  round((epoch_us(last_seen) - epoch_us(cycle_start)) / 6e7, 2) as cycle_elapsed_minutes,
  moisture_ppm < target_moisture_ppm as moisture_threshold_met, last_seen as "timestamp" from oven_material""",
            stretch=LAST_STRETCH, stretch_rows=STRETCH_ROWS, oven_material=PER_MATERIAL,
            newest_silver=f"""select * from s_readings
  qualify row_number() over (partition by oven_id, sensor_type order by {NEWEST}) = 1"""),
    ),
    "known_ovens": (
        lambda lake: st.known_ovens(lake.view("ad_live")), sql("select distinct oven_id from ad_live"),
    ),
    "sensor_fault": (
        lambda lake: st.sensor_fault(lake.view("ad_live")),
        sql("""select oven_id, sensor_type, min(timestamp_opc) as fault_start, max(timestamp_opc) as fault_end,
  count(*) as n_bad from faults where quality = 'Bad' group by oven_id, sensor_type, island
  having max(timestamp_opc) - min(timestamp_opc) > interval '30' second""",
            faults=f"""select *, sum(case when quality <> 'Bad' then 1 else 0 end) over
  (partition by oven_id, sensor_type order by {ARRIVAL} rows unbounded preceding) as island from ad_live"""),
    ),
    "asof_order_stamp": (
        lambda lake: st.asof_order_stamp(lake.readings(), lake.events()).select(
            "reading_id", "oven_id", "timestamp_opc", "order_id"
        ),
        sql("""select reading_id, oven_id, timestamp_opc, case when kind = 'cycle_started' then mark_order end as order_id
  from (select *, last_value(event_type ignore nulls) over w as kind, last_value(event_order ignore nulls) over w as mark_order
    from merged window w as (partition by oven_id order by timestamp_opc, side, id rows unbounded preceding))
  where side = 1""",
            merged="""select reading_id, oven_id, timestamp_opc, 1 as side, cast(reading_id as string) as id,
  null as event_type, null as event_order from s_readings
  union all select null, oven_id, event_time, 0, event_id, event_type, order_id from s_events
  where event_type in ('cycle_started', 'cycle_confirmed', 'cycle_aborted')"""),
    ),
    "cycle_phase": (
        phases,
        sql("""select reading_id, order_id, elapsed as elapsed_minutes, case when elapsed is null or elapsed <= 0 then 'idle'
  when elapsed <= 60 then 'warming' when timestamp_opc >= dry_at then 'complete' else 'drying' end as phase
  from (select *, min(case when sensor_type = 'moisture' and value <= target_moisture_ppm and elapsed > 60
    then timestamp_opc end) over (partition by order_id) as dry_at from tagged)""",
            tagged="""select r.*, target_moisture_ppm,
  (epoch_us(timestamp_opc) - epoch_us(cycle_start_time)) / 6e7 as elapsed
  from s_readings r left join (select p.order_id, cycle_start_time, target_moisture_ppm from s_pairs p
    join s_orders o on p.order_id = o.order_id join s_materials m on m.material_id = o.material_id) c
  on r.order_id = c.order_id"""),
    ),
}
