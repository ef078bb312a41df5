"""Bronze to Silver: typed, cleaned, one row per id or latest version per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cyclelake.functions.timing import to_utc
from cyclelake.schemas import EVENT_PAYLOAD, PAYLOAD_SPARK_TYPE

READING_NOT_NULL = ["timestamp_opc", "oven_id", "sensor_type", "value", "unit", "quality"]


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the first in ``order``. Spark limits each key to one row before the shuffle
    (WindowGroupLimit), so a key with a third of all copies sends one row per map task, not all of them."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def content_order(df: DataFrame):
    """An order of rows that depends on nothing but their values."""
    return F.xxhash64(*df.columns)


def silver_readings(bronze: DataFrame) -> DataFrame:
    """Good readings with all mandatory columns, one per reading_id (earliest delivery)."""
    good = bronze.filter(F.col("quality") == "Good")
    for name in READING_NOT_NULL:
        good = good.filter(F.col(name).isNotNull())
    return first_per_key(good, ["reading_id"], ["timestamp_mqtt", "timestamp_opc", "value"])


def quality_flag(readings: DataFrame) -> DataFrame:
    """Adds is_good_quality without dropping rows."""
    return readings.withColumn("is_good_quality", F.col("quality") == "Good")


def silver_cycle_events(bronze: DataFrame) -> DataFrame:
    """One row per event_id with the payload fields as typed columns."""
    return parse_event_payload(first_per_key(bronze, ["event_id"], ["event_time", "event_type", "payload"]))


def parse_event_payload(events: DataFrame) -> DataFrame:
    """One typed column per payload field over all event types; null where the field is absent or of another
    type. ``payload`` may be JSON text or a variant."""
    kind = events.schema["payload"].dataType.typeName()
    parsed = events.withColumn("_v", F.col("payload") if kind == "variant" else F.try_parse_json("payload"))
    columns = []
    for event_type, fields in EVENT_PAYLOAD.items():
        for name, json_type in fields.items():
            value = F.try_variant_get("_v", f"$.{name}", PAYLOAD_SPARK_TYPE[json_type])
            columns.append(F.when(F.col("event_type") == event_type, value).alias(name))
    return parsed.select(*[c for c in events.columns if c != "payload"], *columns)


def cycle_pairs(events: DataFrame) -> DataFrame:
    """Per order the earliest start, the latest confirmation, its operator and confirmation number."""
    started = F.col("event_type") == "cycle_started"
    confirmed = F.col("event_type") == "cycle_confirmed"
    last = F.max_by(
        F.struct("operator_id", "sap_confirmation_number"), F.when(confirmed, F.struct("event_time", "event_id"))
    )
    return (
        events.filter(started | confirmed)
        .groupBy("order_id")
        .agg(
            F.min(F.when(started, F.col("event_time"))).alias("cycle_start_time"),
            F.max(F.when(confirmed, F.col("event_time"))).alias("cycle_end_time"),
            last.alias("_last"),
        )
        .select(
            "order_id", "cycle_start_time", "cycle_end_time",
            F.col("_last.operator_id").alias("operator_id"),
            F.col("_last.sap_confirmation_number").alias("sap_confirmation_number"),
        )
    )


def latest_version(df: DataFrame, key: str) -> DataFrame:
    """Latest row per key by updated_at, then ingested_at; rows that tie in both are told apart by their content."""
    order = [F.desc("updated_at")] + ([F.desc("ingested_at")] if "ingested_at" in df.columns else [])
    return first_per_key(df, [key], [*order, content_order(df)])


def silver_orders(bronze: DataFrame) -> DataFrame:
    return latest_version(bronze, "order_id")


def silver_materials(bronze: DataFrame) -> DataFrame:
    return latest_version(bronze, "material_id")


def key_violations(df: DataFrame, keys) -> DataFrame:
    """Key combinations that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def normalise_timestamps(df: DataFrame, columns) -> DataFrame:
    """Text columns with any offset, Z or naive text become UTC timestamps; unreadable text becomes null."""
    return df.withColumns({c: to_utc(c) for c in columns})
