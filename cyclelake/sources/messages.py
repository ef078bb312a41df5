"""Sensor messages, captures and shop-floor events: raw text to typed Bronze rows plus the rejected rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclelake.functions.timing import to_utc
from cyclelake.operators.contracts import Json, validate_cycle_event

# Fields every sensor message must have.
REQUIRED = [
    "reading_id", "timestamp_opc", "timestamp_mqtt", "plant", "oven_id", "sensor_type", "value", "unit", "quality",
]
MESSAGE_SCHEMA = "topic string, raw_payload string"


def read_sensor_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Stream of (topic, raw_payload) from a landing folder of JSON lines with these two fields. A Kafka frame
    goes through ``from_kafka`` to the same shape."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def from_kafka(df: DataFrame) -> DataFrame:
    return df.select("topic", F.col("value").cast("string").alias("raw_payload"))


def read_capture(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``topic<space>payload``; lines without a space have a null topic and are not messages."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> ''")
    cut = F.instr("line", " ")
    return lines.select(
        F.when(cut > 0, F.expr("substring(line, 1, instr(line, ' ') - 1)")).alias("topic"),
        F.when(cut > 0, F.expr("substring(line, instr(line, ' ') + 1)")).alias("raw_payload"),
        "line",
    )


def parse_readings(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    """Typed reading columns and ``reject_reason`` (null for a usable row): text that is no JSON object, missing
    fields, a value that is no finite number (numeric text is accepted), unreadable timestamps."""
    json = Json()
    absent = F.array_join(F.array_compact(F.array(*[F.when(json.missing(f), F.lit(f)) for f in REQUIRED])), ", ")
    number = F.when(json.is_a("value", "number") | json.is_a("value", "string"), json.number("value"))
    finite = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    opc, mqtt = to_utc(json.text("timestamp_opc")), to_utc(json.text("timestamp_mqtt"))
    texts = {f: json.text(f) for f in [*REQUIRED, "order_id"]}
    parsed = df.withColumn("_v", F.try_parse_json(raw)).withColumn("_s", json.taken_apart(F.col("_v")))
    read = parsed.select("*", F.inline(F.array(F.struct(F.schema_of_variant("_v").alias("_whole"), *json.read(F.col("_s"))))))
    reason = (
        F.when(F.col("_whole").isNull(), "not valid JSON")
        .when(~F.col("_whole").startswith("OBJECT"), "not a JSON object")
        .when(absent != "", F.concat(F.lit("missing fields: "), absent))
        .when(finite.isNull(), "value is not a finite number")
        .when(opc.isNull() | mqtt.isNull(), "unreadable timestamp")
    )
    typed = {"value": finite, "timestamp_opc": opc, "timestamp_mqtt": mqtt}
    kept = [c for c in df.columns if c not in (*REQUIRED, "order_id")]
    columns = [typed.get(f, texts[f]).alias(f) for f in [*REQUIRED, "order_id"]]
    return read.select(*kept, *columns, reason.alias("reject_reason"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(parsed: DataFrame, raw: str = "raw_payload") -> DataFrame:
    """Quarantine rows: the text and why it was refused."""
    kept = [c for c in ("topic", raw) if c in parsed.columns]
    return parsed.filter(F.col("reject_reason").isNotNull()).select(*kept, "reject_reason")


def split_topic(df: DataFrame) -> DataFrame:
    """Plant, oven and sensor of ``factory/{plant}/{oven}/{sensor}``, and whether they agree with the payload
    columns where those exist."""
    parts = F.split("topic", "/")
    good = (F.size(parts) == 4) & (F.get(parts, F.lit(0)) == "factory")
    named = df.withColumns({
        "topic_plant": F.when(good, F.get(parts, F.lit(1))),
        "topic_oven_id": F.when(good, F.get(parts, F.lit(2))),
        "topic_sensor_type": F.when(good, F.get(parts, F.lit(3))),
    })
    agree = good
    for column in ("plant", "oven_id", "sensor_type"):
        if column in df.columns:
            agree = agree & F.col(f"topic_{column}").eqNullSafe(F.col(column))
    return named.withColumn("topic_agrees", agree)


def ingest_cycle_events(df: DataFrame, raw: str = "raw_payload") -> tuple[DataFrame, DataFrame]:
    """Valid events as Bronze rows (raw text kept) and the refused ones with their errors."""
    checked = validate_cycle_event(df, raw)
    json = F.try_parse_json(raw)
    text = lambda f: F.try_variant_get(json, f"$.{f}", "string").alias(f)
    bronze = checked.filter("is_valid").select(
        raw, text("event_id"), text("event_type"), text("order_id"), text("oven_id"), text("operator_id"),
        to_utc(F.try_variant_get(json, "$.timestamp", "string")).alias("event_time"), text("payload"),
    )
    return bronze, checked.filter(~F.col("is_valid")).select(raw, "errors")
