"""Silver as tables that are clustered by order: what is joined and grouped by order_id is not shuffled again."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from cyclelake.operators import gold as g
from cyclelake.operators import silver as s

CLUSTERED = {"readings": ["timestamp_opc"], "events": ["event_time"], "orders": [], "order_state": []}


def write_clustered(df: DataFrame, table: str, path: str, order=(), key: str = "order_id", buckets: int = 64) -> None:
    """Writes ``df`` as an external table of ``buckets`` hash buckets by ``key``, sorted inside by key and ``order``. One task writes
    one bucket, so a bucket is one file; a key that holds a third of all rows makes one long file, which readers still
    split by row groups where they need no clustering."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order)
    writer.option("path", path).saveAsTable(table)


def input_megabytes(spark: SparkSession, *frames: DataFrame) -> float:
    """Size of all files that the frames read; a frame that reads none counts nothing."""
    uris = {file for df in frames for file in df.inputFiles()}
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)) for uri in uris]
    return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths) / 1e6


def write_silver(spark: SparkSession, folder: str, prefix: str, buckets: int = 64, bucket_mb: float = 16.0, **frames: DataFrame) -> dict[str, str]:
    """Silver frames (readings, events, orders, order_state, all by order_id) as clustered tables with the same buckets: one for every
    ``bucket_mb`` of the files that they are read from, at least ``buckets``, so that a task's share does not grow with the tables. Returns
    the table names."""
    buckets = max(buckets, math.ceil(input_megabytes(spark, *frames.values()) / bucket_mb))
    names = {kind: f"{prefix}_{kind}" for kind in frames}
    for kind, df in frames.items():
        write_clustered(df, names[kind], f"{folder}/{kind}", CLUSTERED[kind], buckets=buckets)
    return names


def gold_over_tables(spark: SparkSession, names: dict[str, str], materials: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Gold from the tables of ``write_silver``: grouping readings and events and joining orders need no exchange."""
    tables = {kind: spark.table(name) for kind, name in names.items()}
    return g.gold_cycle_summary(s.cycle_pairs(tables["events"]), tables["orders"], materials, tables["readings"],
                                tables.get("order_state"), tolerance)
