"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclelake.session import staging_path

# Fixed value: what separates words. Everything else belongs to a word.
BLANKS = "\t\n\x0b\x0c\r "
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches that tasks hand to Python end after some megabytes, as whole texts may be long. A setting of the user's is left alone."""
    if spark.conf.get(BATCH_BYTES) == "67108864b":    # Spark's own default
        spark.conf.set(BATCH_BYTES, str(MOST_BATCH_BYTES))


def release_memory() -> None:
    """Gives what a worker has freed back to the system. Workers live on after a partition, beside those of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):    # another C library
        pass


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage is cut, later reads cost a scan, and the
    optimizer knows its true size when it chooses joins. The shuffle files of the write are freed at once. ``by``: a column
    with few values that gets a folder for each."""
    spark = df.sparkSession
    small_batches(spark)
    path = staging_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(table: DataFrame, part: str | None = None) -> None:
    """Removes a table made by ``staged`` (or one of its folders) that nothing reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table.staged_path}/{part}" if part else table.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str) -> Column:
    """Number of words; null and blank texts have none."""
    trimmed = F.btrim(text_or_empty(column), F.lit(BLANKS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[\\x09-\\x0D\\x20]+"))).cast("bigint")


def is_held_out(id_column: str) -> Column:
    """One row in five, by its id: never used to learn labels. Rows without an id are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
