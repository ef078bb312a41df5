"""Reference data: list envelopes, snapshots and seed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclelake.functions.timing import as_of_column
from cyclelake.sources.tables import exists


def read_odata_list(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the list envelopes ``{count, value: [...]}`` below ``path`` (one file per page), each with the
    flag ``count_matches``."""
    envelope = T.StructType([T.StructField("count", T.LongType()), T.StructField("value", T.ArrayType(schema))])
    pages = spark.read.schema(envelope).option("multiLine", True).json(path)
    return pages.select((F.col("count") == F.size("value")).alias("count_matches"), F.inline("value"))


def snapshot_refresh(df: DataFrame, target: str, as_of=None) -> None:
    """Full-replace pull: the snapshot of the day is replaced as a whole, so a repeated run changes nothing."""
    stamped = df.withColumn("ingested_at", as_of_column(as_of)).withColumn("ingest_date", F.to_date("ingested_at"))
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("ingest_date").parquet(target)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Seed array with declared types; a missing boolean is false."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    flags = [f.name for f in schema if isinstance(f.dataType, T.BooleanType)]
    return df.fillna(False, flags) if flags else df


def load_seed(df: DataFrame, bronze: str, key: str, gold: str) -> None:
    """Appends seed rows to Bronze while Gold is still empty; keys already there are left out, so repeats are
    no-ops."""
    spark = df.sparkSession
    if exists(spark, gold) and not spark.read.parquet(gold).isEmpty():
        return
    new = df
    if exists(spark, bronze):
        new = df.join(spark.read.parquet(bronze).select(key), key, "left_anti")
    new.withColumn("ingested_at", F.current_timestamp()).write.mode("append").parquet(bronze)
