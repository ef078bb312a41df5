"""Table writers on plain Parquet: Bronze appends, latest-wins upserts, marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclelake.functions.timing import as_of_column
from cyclelake.operators.silver import content_order, first_per_key
from cyclelake.sources.versions import append, compact, expire, file_system, merge, path_of, read_snapshot, snapshot


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished write is there (or, for appended stream output, any content)."""
    fs = file_system(spark, path)
    return fs.exists(path_of(spark, path)) and len(fs.listStatus(path_of(spark, path))) > 0


def append_bronze(df: DataFrame, target: str, raw: str = "raw_payload", as_of=None, batch=None, most_parts: int = 24) -> None:
    """Immutable append with ingested_at and the raw text, cut by ingest date.

    Without ``batch`` to plain Parquet folders. In a stream pass ``batch`` (stream, number): rows then go to a versioned table
    with one bucket per day, in which a repeated batch counts once, also after midnight; days of more than ``most_parts`` batches
    are compacted without readers noticing. Read it with ``read_bronze``."""
    rows = df if raw in df.columns else df.withColumn(raw, F.to_json(F.struct(*df.columns)))
    rows = rows.withColumn("ingested_at", as_of_column(as_of)).withColumn("ingest_date", F.to_date("ingested_at"))
    if batch is None:
        rows.write.mode("append").partitionBy("ingest_date").parquet(target)
        return
    append(rows, target, ["ingest_date"], None, batch)
    compact(df.sparkSession, target, most=most_parts)
    expire(df.sparkSession, target)


def read_bronze(spark: SparkSession, target: str, first_day=None, last_day=None) -> DataFrame:
    """Bronze of a stream; only the days from ``first_day`` to ``last_day`` (dates) are read."""
    manifest = snapshot(spark, target)
    if manifest is None:
        raise FileNotFoundError(f"no version of {target} has been published")
    day = lambda d: (d - date(1970, 1, 1)).days
    wanted = {int(b) for b in manifest["buckets"]
              if (first_day is None or int(b) >= day(first_day)) and (last_day is None or int(b) <= day(last_day))}
    return read_snapshot(spark, target, manifest, wanted)


def write_batch(df: DataFrame, target: str, batch_id: int) -> None:
    """One micro-batch as its own partition; repeating it gives the same table."""
    writer = df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target)


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table written by ``write_batch``, with its declared schema: readable before its first row is there."""
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return spark.read.schema(declared).parquet(path) if exists(spark, path) else spark.createDataFrame([], declared)


def upsert_latest(new: DataFrame, target: str, keys, version: str | None, buckets: int = 64) -> None:
    """Inserts or replaces rows by key; the row with the highest ``version`` wins, so repeats are harmless. At equal
    version, and for any version when it is None, new rows replace stored ones; among new rows that tie, content decides.

    The table is versioned and cut by a hash bucket of the key: a row never changes its bucket, only buckets that the new
    rows touch are read and written again, and all of them appear in one step. Read it with ``read_upserted``.
    """
    order = [F.desc(version)] if version else []
    merge(new, target, keys, lambda rows: first_per_key(rows, list(keys), [*order, F.desc("_new"), content_order(new)]), buckets)


def replace_keys(keys_to_drop: DataFrame, rows: DataFrame, target: str, keys, buckets: int = 64) -> None:
    """Takes the keys of ``keys_to_drop`` out of a versioned table and puts ``rows`` (of these keys) in, in one step."""
    marked = keys_to_drop.select(*keys).distinct().withColumn("_there", F.lit(False)).unionByName(
        rows.withColumn("_there", F.lit(True)), allowMissingColumns=True)
    newest = lambda both: first_per_key(both, list(keys), [F.desc("_new"), F.desc("_there"), content_order(rows)])
    merge(marked, target, keys, lambda both: newest(both).filter("_there"), buckets)


def read_upserted(spark: SparkSession, target: str) -> DataFrame:
    """The newest version, the same rows however often the result is read."""
    manifest = snapshot(spark, target)
    if manifest is None:
        raise FileNotFoundError(f"no version of {target} has been published")
    return read_snapshot(spark, target, manifest).drop("_there")


def write_mart(gold: DataFrame, target: str) -> None:
    """Gold for dashboards, partitioned by plant and month of the cycle end so that filters prune."""
    dated = gold.withColumn("month", F.date_format("cycle_end_time", "yyyy-MM"))
    dated.hint("rebalance", "plant", "month").write.mode("overwrite").partitionBy("plant", "month").parquet(target)
