"""Queries over sources and sinks: what was written to the shared folder is read back and returned."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclelake.operators import contracts as c
from cyclelake.operators import gold as g
from cyclelake.plans.checks import sql
from cyclelake.schemas import EVENT, MATERIAL, ORDER
from cyclelake.session import staging_path
from cyclelake.sources import messages as m
from cyclelake.sources import reference as ref
from cyclelake.sources import tables as t
from cyclelake.sources.capture_source import CaptureSource

PAGE = 500


def capture(lake):
    """Messages written as a capture file, some lines without a payload, read back and checked."""
    path = staging_path(lake.spark, "capture")
    line = F.when(F.col("event_id") % 47 == 0, F.col("topic")).otherwise(F.concat_ws(" ", "topic", "raw_payload"))
    lake.view("m_readings").select(line).write.text(path)
    messages = m.read_capture(lake.spark, path).filter(F.col("topic").isNotNull())
    return c.validate_reading(messages).select("topic", "raw_payload", "is_valid")


def captured_stream(lake):
    """The same capture as a stream of its own source, which reads the moisture topics only."""
    path, out = staging_path(lake.spark, "capture"), staging_path(lake.spark, "captured")
    lake.view("m_readings").select(F.concat_ws(" ", "topic", "raw_payload")).write.text(path)
    lake.spark.dataSource.register(CaptureSource)
    stream = lake.spark.readStream.format("capture").option("topics", "factory/+/+/moisture").load(path)
    stream.select("topic", "raw_payload").writeStream.format("parquet").option(
        "checkpointLocation", staging_path(lake.spark, "progress")).option("path", out).trigger(
        availableNow=True).start().awaitTermination()
    return lake.spark.read.parquet(out)


def landed(lake):
    """Messages landed as JSON lines, taken by the file stream, parsed into Bronze."""
    landing, out = staging_path(lake.spark, "landing"), staging_path(lake.spark, "bronze")
    lake.view("m_readings").select("topic", "raw_payload").write.json(landing)
    stream = m.accepted(m.parse_readings(m.read_sensor_stream(lake.spark, landing)))
    stream.writeStream.format("parquet").option("checkpointLocation", staging_path(lake.spark, "progress")).option(
        "path", out).trigger(availableNow=True).start().awaitTermination()
    return lake.spark.read.parquet(out).drop("raw_payload")


def events_in(lake):
    """Every event, accepted with its fields or refused."""
    good, bad = m.ingest_cycle_events(lake.view("m_events"))
    kept = ["raw_payload", "event_id", "event_type", "order_id", "oven_id", "operator_id", "event_time"]
    refused = bad.select("raw_payload", F.lit("refused").alias("event_type"))
    return good.select(*kept).unionByName(refused, allowMissingColumns=True)


def odata(lake):
    """Orders written as list envelopes of 500 rows per page and read back; one page in three claims one row
    too many."""
    path = staging_path(lake.spark, "odata")
    rows = lake.view("ad_orders").withColumn("standard_cycle_minutes", F.lit(480))
    row = F.struct("order_id", "material_id", "plant", "oven_id", "planned_start", "planned_end",
                   "standard_cycle_minutes", "operator_id")
    page = F.floor(F.col("o_orderkey") / PAGE)
    pages = rows.groupBy(page.alias("page")).agg(F.collect_list(row).alias("value"))
    wrong = F.when(F.col("page") % 3 == 0, 1).otherwise(0)
    pages.select((F.size("value") + wrong).alias("count"), "value").write.option("maxRecordsPerFile", 1).json(path)
    return ref.read_odata_list(lake.spark, path, ORDER).select(
        "order_id", "material_id", "planned_start", "goods_movement_posted", "count_matches"
    )


def snapshots(lake):
    """Two pulls on one day and one on the next; a pull replaces its day."""
    path = staging_path(lake.spark, "snapshots")
    orders = lake.orders().drop("ingested_at")
    ref.snapshot_refresh(orders.filter("status = 'CONFIRMED'"), path, "2024-01-01 08:00:00")
    ref.snapshot_refresh(orders, path, "2024-01-01 09:00:00")
    ref.snapshot_refresh(orders.filter("plant = 'regensburg'"), path, "2024-01-02 08:00:00")
    return lake.spark.read.parquet(path).select("ingested_at", "order_id", "status", "oven_id", "updated_at")


def seeded(lake):
    """Materials written as seed arrays of 500 rows, loaded twice: the second load changes nothing."""
    seed, bronze, gold = (staging_path(lake.spark, n) for n in ("seed", "seed-bronze", "seed-gold"))
    materials = lake.view("br_materials")
    page = F.floor(F.unix_seconds("updated_at") / PAGE)
    arrays = materials.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*materials.columns)).alias("rows"))
    arrays.select(F.to_json("rows")).write.option("maxRecordsPerFile", 1).text(seed)
    rows = ref.read_seed(lake.spark, seed, MATERIAL).withColumn(
        "version_id", F.concat_ws("@", "material_id", F.col("updated_at").cast("string"))
    )
    ref.load_seed(rows, bronze, "version_id", gold)
    ref.load_seed(rows, bronze, "version_id", gold)
    return lake.spark.read.parquet(bronze).groupBy("material_id").agg(
        F.count(F.lit(1)).alias("n_versions"), F.max("updated_at").alias("updated_at"),
        F.max("weight_kg").alias("weight_kg"),
    )


def appended(lake):
    """Movements appended to Bronze in two runs; the raw text is kept."""
    path = staging_path(lake.spark, "movements")
    movements = lake.view("br_movements")
    t.append_bronze(movements.filter("storage_location = 'WH-01'"), path, as_of="2024-01-01 08:00:00")
    t.append_bronze(movements.filter("storage_location <> 'WH-01'"), path, as_of="2024-01-02 08:00:00")
    return lake.spark.read.parquet(path).select(
        "document_number", "order_id", "ingested_at", F.get_json_object("raw_payload", "$.storage_location").alias("raw_location")
    )


def upserted(lake):
    """Order versions upserted oldest first in three runs, one of them twice: the latest version stays, and of equal rows one."""
    path = staging_path(lake.spark, "orders")
    versions = lake.view("br_orders").drop("ingested_at")
    for statuses in (["CREATED"], ["RELEASED", "IN_PROGRESS"], ["CONFIRMED", "ABORTED"], ["CREATED"]):
        t.upsert_latest(versions.filter(F.col("status").isin(*statuses)), path, ["order_id"], "updated_at", 16)
    return t.read_upserted(lake.spark, path)


def mart(lake):
    path = staging_path(lake.spark, "mart")
    t.write_mart(lake.gold(), path)
    return lake.spark.read.parquet(path).groupBy("plant", F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n_cycles"), F.sum("delta_minutes").alias("delta_minutes")
    )


VALUE = "try_cast(json_extract_string(j, '$.value') as double)"
PARSED = f"""select *, case when j is null then 'not valid JSON' when json_type(j) <> 'OBJECT' then 'not a JSON object'
  when json_type(j, '$.value') is null then 'missing fields: value'
  when {VALUE} is null or json_type(j, '$.value') = 'BOOLEAN' then 'value is not a finite number' end as reject_reason
  from (select *, case when json_valid(raw_payload) and not contains(raw_payload, 'NaN') then raw_payload::json end as j
    from m_readings)"""
TEXT = "json_extract_string(j, '$.{0}') as {0}".format

READ = f"""topic, {TEXT('reading_id')}, {TEXT('plant')}, {TEXT('oven_id')}, {TEXT('sensor_type')},
  {VALUE} as value, {TEXT('unit')}, {TEXT('quality')}, {TEXT('order_id')},
  cast(cast(json_extract_string(j, '$.timestamp_opc') as timestamptz) at time zone 'UTC' as timestamp) as timestamp_opc,
  cast(cast(json_extract_string(j, '$.timestamp_mqtt') as timestamptz) at time zone 'UTC' as timestamp) as timestamp_mqtt"""

QUERIES = {
    "parse_readings": (
        lambda lake: m.accepted(m.parse_readings(lake.view("m_readings").select("topic", "raw_payload"))).drop("raw_payload"),
        sql(f"select {READ} from parsed where reject_reason is null", parsed=PARSED),
    ),
    "quarantined_readings": (
        lambda lake: m.rejected(m.parse_readings(lake.view("m_readings").select("topic", "raw_payload"))),
        sql("select topic, raw_payload, reject_reason from parsed where reject_reason is not null", parsed=PARSED),
    ),
    "split_topic": (
        lambda lake: m.split_topic(lake.view("m_readings").select("event_id", "topic", "plant", "oven_id", "sensor_type")).select(
            "event_id", "topic_plant", "topic_oven_id", "topic_sensor_type", "topic_agrees"
        ),
        sql("""select event_id, split_part(topic, '/', 2) as topic_plant, split_part(topic, '/', 3) as topic_oven_id,
  split_part(topic, '/', 4) as topic_sensor_type, split_part(topic, '/', 2) = plant as topic_agrees from m_readings"""),
    ),
    "read_capture": (
        capture,
        None,
    ),
    "capture_stream": (captured_stream, sql("select topic, raw_payload from m_readings where sensor_type = 'moisture'")),
    "sensor_landing_stream": (landed, sql(f"select {READ} from parsed where reject_reason is null", parsed=PARSED)),
    "ingest_cycle_events": (events_in, None),
    "read_odata_list": (
        odata,
        sql(f"""select order_id, material_id, planned_start, cast(null as boolean) as goods_movement_posted,
  (o_orderkey // {PAGE}) % 3 <> 0 as count_matches from ad_orders"""),
    ),
    "snapshot_refresh": (
        snapshots,
        sql("""select timestamp '2024-01-01 09:00:00' as ingested_at, order_id, status, oven_id, updated_at from s_orders
  union all select timestamp '2024-01-02 08:00:00', order_id, status, oven_id, updated_at from s_orders where plant = 'regensburg'"""),
    ),
    "load_seed": (
        seeded,
        sql("""select material_id, count(*) as n_versions, max(updated_at) as updated_at, max(weight_kg) as weight_kg
  from br_materials group by 1"""),
    ),
    "append_bronze": (
        appended,
        sql("""select document_number, order_id, case when storage_location = 'WH-01' then timestamp '2024-01-01 08:00:00'
  else timestamp '2024-01-02 08:00:00' end as ingested_at, storage_location as raw_location from br_movements"""),
    ),
    "upsert_latest": (upserted, sql("select * exclude (ingested_at) from s_orders")),
    "write_mart": (
        mart,
        sql("""select plant, strftime(cycle_end_time, '%Y-%m') as month, count(*) as n_cycles,
  sum(delta_minutes) as delta_minutes from gold group by 1, 2"""),
    ),
}


def _late_references():
    """Reference SQL that reuses the contract rules."""
    from cyclelake.plans.catalog.contract import ALL

    query, _ = QUERIES["read_capture"]
    QUERIES["read_capture"] = (query, sql(
        """select m.topic, m.raw_payload, len(errors) = 0 as is_valid
  from m_readings m join checked_c1 c on m.event_id = c.event_id where m.event_id % 47 <> 0""", **ALL))
    query, _ = QUERIES["ingest_cycle_events"]
    QUERIES["ingest_cycle_events"] = (query, sql(
        """select raw_payload, json_extract_string(raw_payload, '$.event_id') as event_id,
    json_extract_string(raw_payload, '$.event_type') as event_type, json_extract_string(raw_payload, '$.order_id') as order_id,
    json_extract_string(raw_payload, '$.oven_id') as oven_id, json_extract_string(raw_payload, '$.operator_id') as operator_id,
    cast(replace(replace(json_extract_string(raw_payload, '$.timestamp'), 'T', ' '), 'Z', '') as timestamp) as event_time
    from checked_c10 where len(errors) = 0
  union all select raw_payload, null, 'refused', null, null, null, null from checked_c10 where len(errors) > 0""", **ALL))


_late_references()
