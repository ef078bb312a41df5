"""Session settings and the shared folder for cut lineage and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app="cyclelake", master=None, shuffle_partitions=None, extra=None) -> SparkSession:
    """A session with the settings the operators rely on: UTC, AQE with skew handling, no web page."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session without that setting gets its own folder."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = context._jsc.sc().getCheckpointDir()
        folder = current.get() if current.isDefined() else None
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="cyclelake-")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for a staged table or a stream checkpoint."""
    return f"{shared_dir(spark)}/cyclelake/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: what it costs is paid once, and later reads take only the columns
    they need."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
