"""Streaming queries: each runs its stream over the table files until nothing is left, then returns the sink."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cyclelake.operators import silver as s
from cyclelake.operators import timeseries as ts
from cyclelake.plans.catalog.bronze import PARSED, VALUE
from cyclelake.plans.catalog.series import DRYING, ETA, JUMPS, STALLED, VACUUM, oven_setpoints, shown_eta, targets
from cyclelake.plans.catalog.state import AS_OF, PARTS
from cyclelake.plans.checks import sql
from cyclelake.session import staged, staging_path
from cyclelake.sources.tables import read_bronze, read_upserted
from cyclelake.streaming import jobs as j


def finish(lake, writer):
    with j.rocksdb(lake.spark, count_rows=False):
        j.start(writer, staging_path(lake.spark, "progress")).awaitTermination()


def through_table(lake, stream):
    """Runs an append stream into a table and reads it back."""
    path = staging_path(lake.spark, "out")
    finish(lake, j.append_sink(stream, path))
    return lake.spark.read.schema(stream.schema).parquet(path)


def bronze(lake):
    good, bad = staging_path(lake.spark, "bronze"), staging_path(lake.spark, "quarantine")
    messages = lake.view("m_readings", live=["events"]).select("topic", "raw_payload")
    finish(lake, j.bronze_stream(messages, good, bad))
    stored = read_bronze(lake.spark, good).select(F.col("quality").alias("kind"), "reading_id", "oven_id", "value", "timestamp_opc", "raw_payload")
    refused = j.read_quarantine(lake.spark, bad).select(F.col("reject_reason").alias("kind"), "raw_payload")
    return stored.unionByName(refused, allowMissingColumns=True)


def deliveries(lake):
    """Bronze readings with their arrival: 0 for the first good delivery of a reading, 1 for repeated ones."""
    delivery = W.partitionBy("reading_id", F.col("quality") == "Good").orderBy("timestamp_mqtt", "timestamp_opc", "value")
    return lake.view("br_readings").withColumn("part", F.least(F.lit(1), F.row_number().over(delivery) - 1))


def silver(lake):
    """Two arrivals, the second with all repeated deliveries."""
    rows = deliveries(lake)
    landing, out, progress = (staging_path(lake.spark, n) for n in ("landing", "out", "progress"))
    rows.write.partitionBy("part").parquet(landing)
    for part in (0, 1):
        stream = lake.spark.readStream.schema(rows.drop("part").schema).option("recursiveFileLookup", "true").parquet(
            f"{landing}/part={{{','.join(map(str, range(part + 1)))}}}")
        with j.rocksdb(lake.spark, count_rows=False):
            j.start(j.append_sink(j.silver_readings_stream(stream, "9000 days"), out), progress).awaitTermination()
    return lake.spark.read.schema(rows.drop("part").schema).parquet(out)


def windows(lake):
    stats = through_table(lake, j.channel_window_stats(lake.view("ad_live", live=["events"])))
    return stats.withColumn("mean", F.round("mean", 6))


def pairs(lake):
    stream = j.pair_stream(lake.view("br_events", live=["orders"]))
    return through_table(lake, stream)


def late_orders(lake):
    limits = lake.orders().select("order_id", "material_id").join(
        lake.materials().select("material_id", "max_cycle_minutes"), "material_id"
    ).select("order_id", "max_cycle_minutes")
    extensions = lake.view("br_extensions", live=["orders"])
    return through_table(lake, j.timeout_stream(lake.view("br_events", live=["orders"]), limits, extensions, "1 hour"))


def gold(lake):
    """Two arrivals: in the first the orders of a third of the cycles and half of the events are missing, in the second come
    these and all repeated deliveries of readings."""
    state, target, waiting = (staging_path(lake.spark, n) for n in ("states", "gold", "pending"))
    log = lake.view("br_events")
    late = F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0
    landings = {"events": log.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(2))),
                "readings": deliveries(lake)}
    landed, progress = {name: staging_path(lake.spark, name) for name in landings}, staging_path(lake.spark, "progress")
    for name, rows in landings.items():
        rows.write.partitionBy("part").parquet(landed[name])
    with j.rocksdb(lake.spark, count_rows=False):
        for part in (0, 1):
            def dimensions(changed, part=part):
                orders = lake.view("br_orders").join(changed, "order_id", "left_semi")
                orders = orders if part else orders.filter(~late)
                return s.silver_orders(orders), lake.materials(), lake.order_state()

            # Later deliveries become visible to the same streams as more files.
            live = {n: lake.spark.readStream.schema(r.drop("part").schema).option("recursiveFileLookup", "true").parquet(
                f"{landed[n]}/part={{{','.join(map(str, range(part + 1)))}}}") for n, r in landings.items()}
            j.start(j.gold_stream(live["events"], live["readings"], dimensions, state, target, waiting, delay="9000 days",
                                  buckets=4), progress).awaitTermination()
    return read_upserted(lake.spark, target)


def state(lake):
    target = staging_path(lake.spark, "state")
    finish(lake, j.process_state_stream(lake.view("ad_live", live=["events"]), target, buckets=4))
    return j.read_process_state(lake.spark, target, 50.0, 2160.0, AS_OF)


def alerts(lake):
    """Four arrivals with moisture one block late; the phase comes from the cycles of the live orders."""
    context, found = staging_path(lake.spark, "context"), staging_path(lake.spark, "alerts")
    setpoints, cycles = oven_setpoints(lake), lake.view("ad_cycles")
    rules = {
        "moisture stalled": ts.moisture_stalled_rule(5.0, 240, ["oven_id"]),
        "temperature spike": ts.temperature_spike_rule(100.0, ["oven_id"], setpoints),
        "vacuum loss": ts.vacuum_loss_rule(setpoints, ["oven_id"]),
    }
    in_blocks(lake, lambda stream: j.alerts_stream(
        stream, context, found, rules, "oven_id", 17 * 1440, lambda r: ts.with_phase(r, cycles), buckets=4))
    return j.read_alerts(lake.spark, found).select("rule", "reading_id", "oven_id", "value")


def arrival():
    """Block of eight days in which a reading arrives; moisture arrives one block late."""
    block = F.floor((F.dayofmonth("timestamp_opc") - 1) / 8)
    return F.least(F.lit(3), block + F.when(F.col("sensor_type") == "moisture", 1).otherwise(0))


def in_blocks(lake, job):
    """Runs the job over the live readings as they arrive, block by block."""
    landing, progress = staging_path(lake.spark, "landing"), staging_path(lake.spark, "progress")
    rows = lake.view("ad_live").withColumn("_block", arrival())
    for block in range(4):
        rows.filter(F.col("_block") == block).drop("_block").write.mode("append").parquet(landing)
        j.start(job(lake.spark.readStream.schema(rows.drop("_block").schema).parquet(landing)), progress).awaitTermination()


def late(lake):
    found = staging_path(lake.spark, "late")
    in_blocks(lake, lambda stream: j.late_report(stream, found, 10))
    return read_upserted(lake.spark, found).select("reading_id", "sensor_type", "timestamp_opc", "watermark")


def ring(lake):
    kept = staging_path(lake.spark, "ring")
    in_blocks(lake, lambda stream: j.ring_stream(stream, kept, 100, 4))
    return read_upserted(lake.spark, kept).select("oven_id", "sensor_type", "reading_id", "value")


def eta(lake):
    """Readings of every order in three arrivals; the estimate comes from the sums alone."""
    sums, landing, progress = (staging_path(lake.spark, n) for n in ("sums", "landing", "progress"))
    known = tuple(staged(df, name) for name, df in {
        "pairs": lake.pairs().select("order_id", "cycle_start_time", "cycle_end_time"),
        "orders": lake.orders().select("order_id", "material_id"), "materials": lake.materials()}.items())
    rows = lake.readings()
    rows.withColumn("part", F.pmod(F.xxhash64("reading_id"), F.lit(3))).write.partitionBy("part").parquet(landing)
    for part in range(3):
        # Later arrivals become visible to the same stream as more files.
        stream = lake.spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(
            f"{landing}/part={{{','.join(map(str, range(part + 1)))}}}")
        j.start(j.eta_stream(stream, lambda: known, sums, 4, 2), progress).awaitTermination()
    return shown_eta(j.read_eta(lake.spark, sums, targets(lake, known)))


QUERIES = {
    "bronze_stream": (
        bronze,
        sql(f"""select coalesce(reject_reason, json_extract_string(j, '$.quality')) as kind, raw_payload,
  case when reject_reason is null then json_extract_string(j, '$.reading_id') end as reading_id,
  case when reject_reason is null then json_extract_string(j, '$.oven_id') end as oven_id,
  case when reject_reason is null then {VALUE} end as value, case when reject_reason is null then
    cast(cast(json_extract_string(j, '$.timestamp_opc') as timestamptz) at time zone 'UTC' as timestamp) end as timestamp_opc
  from parsed""", parsed=PARSED),
    ),
    "silver_readings_stream": (
        silver,
        sql("""select reading_id, order_id, oven_id, plant, sensor_type, value, unit, quality, timestamp_opc, timestamp_mqtt
  from s_readings"""),
    ),
    "channel_window_stats": (
        windows,
        sql("""select * from (select time_bucket(interval '5' minute, timestamp_opc) as window_start, oven_id, sensor_type,
  count(*) as n_readings, min(value) as low, max(value) as high, round(avg(value), 6) as mean,
  arg_max(value, struct_pack(a := timestamp_opc, b := reading_id)) as last from ad_live group by 1, 2, 3)
  where window_start + interval '5' minute <= (select max(timestamp_opc) - interval '10' minute from ad_live)"""),
    ),
    "pair_stream": (
        pairs,
        sql("""select b.order_id, b.event_time as cycle_start_time, e.event_time as cycle_end_time, e.operator_id
  from s_events b join s_events e on b.order_id = e.order_id and b.event_type = 'cycle_started'
  and e.event_type = 'cycle_confirmed' and e.event_time > b.event_time
  and e.event_time <= b.event_time + interval '24' hour"""),
    ),
    "timeout_stream": (
        late_orders,
        sql("""select order_id, started_at, timeout_at, cast(limit_now as integer) as max_cycle_minutes from due d where not exists (
    select 1 from ends e where e.order_id = d.order_id and e.event_time between d.started_at and d.timeout_at)
  and timeout_at < (select max(seen) - interval '1' hour from (select max(event_time) as seen from s_events
    where event_type in ('cycle_started', 'cycle_confirmed', 'cycle_aborted') union all select max(extended_at) from br_extensions))""",
            starts="""select e.order_id, event_id, event_time as started_at, max_cycle_minutes,
    lead(event_time) over (partition by e.order_id order by event_time, event_id) as next_start from s_events e
    join s_orders o on o.order_id = e.order_id join s_materials m on m.material_id = o.material_id
    where event_type = 'cycle_started'""",
            ends="select * from s_events where event_type in ('cycle_confirmed', 'cycle_aborted')",
            steps="""select s.order_id, event_id, started_at, max_cycle_minutes, extended_at, minutes,
    row_number() over (partition by event_id order by extended_at, minutes) as step from starts s
    join br_extensions x on x.order_id = s.order_id and x.extended_at >= started_at
      and (next_start is null or x.extended_at < next_start)""",
            ladder="""select *, started_at + limit_now * interval '1' minute as timeout_at from (
      select order_id, event_id, started_at, 0 as step, max_cycle_minutes as limit_now from starts
      union all select order_id, event_id, started_at, step, max_cycle_minutes + sum(minutes) over (
        partition by event_id order by step rows between unbounded preceding and current row) from steps) laddered""",
            due="""select l.* from ladder l where not exists (select 1 from steps s where s.event_id = l.event_id
      and s.step = l.step + 1 and s.extended_at <= l.timeout_at)"""),
    ),
    "gold_stream": (gold, sql("select * from gold")),
    "process_state_stream": (state, sql("select * from oven_state", **PARTS)),
    "alerts_stream": (
        alerts,
        sql("select 'moisture stalled' as rule, reading_id, oven_id, value from (" + STALLED.replace("ad_live", "drying") + ")" + """
  union all select 'temperature spike', reading_id, oven_id, value from jumps
  where abs(value - previous_value) > 100 or value > setpoint + 2
  union all select 'vacuum loss', reading_id, oven_id, value from vacuum
  where lowest_before <= setpoint_vacuum_mbar + 0.5 and value > setpoint_vacuum_mbar + 0.5""", jumps=JUMPS, vacuum=VACUUM, drying=DRYING),
    ),
    "late_report": (
        late,
        sql("""select reading_id, sensor_type, timestamp_opc, watermark from blocks b join
  (select block, date_trunc('millisecond', max(newest) over (order by block rows between unbounded preceding and 1 preceding)
    - interval '10' minute) as watermark from (select block, max(timestamp_opc) as newest from blocks group by block)) w
  on b.block = w.block where timestamp_opc <= watermark""",
            blocks="""select *, least(3, (day(timestamp_opc) - 1) // 8 + case when sensor_type = 'moisture' then 1 else 0 end)
    as block from ad_live"""),
    ),
    "retain_last_n_stream": (
        ring,
        sql("""select oven_id, sensor_type, reading_id, value from ad_live qualify row_number() over (
    partition by oven_id, sensor_type order by timestamp_opc desc, timestamp_mqtt desc, reading_id desc) <= 100"""),
    ),
    "cycle_end_eta_stream": (eta, ETA),
}
