"""Versioned tables on plain Parquet.

    <table>/data/<id>/_bucket=<n>/part-*     written once and never changed
    <table>/versions/<number>.json           a manifest: which folders make up each bucket

A writer puts its rows beside the table and then publishes a manifest by a rename that fails where the number is taken. Until
then nobody sees the rows; a writer that dies leaves the version before it and some folders that ``expire`` removes. A
reader takes the newest manifest once and reads the folders it names, whatever is published meanwhile. Rows are cut by a hash
bucket of their key, or by day, so manifests stay small and a writer replaces the buckets it touches only.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"


class VersionTaken(Exception):
    """Another writer has published the version that this one was about to."""


def path_of(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return path_of(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def bucket_of(keys, buckets: int | None):
    """The bucket of a row: by hash of its key or, without a number of buckets, the day (since 1970) of its only key, a date."""
    if buckets is None:
        return F.unix_date(keys[0])
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _listed(spark: SparkSession, folder: str) -> list:
    fs, path = file_system(spark, folder), path_of(spark, folder)
    return list(fs.listStatus(path)) if fs.exists(path) else []


def versions(spark: SparkSession, table: str) -> list[int]:
    """Published versions, oldest first."""
    names = [str(s.getPath().getName()) for s in _listed(spark, f"{table}/versions")]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def snapshot(spark: SparkSession, table: str, version: int | None = None) -> dict | None:
    """The manifest of a version, the newest unless named; None before the first. Keep it to read the same rows again."""
    if version is None:
        known = versions(spark, table)
        if not known:
            return None
        version = known[-1]
    path = path_of(spark, f"{table}/versions/{version:012d}.json")
    stream = file_system(spark, table).open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_snapshot(spark: SparkSession, table: str, manifest: dict, buckets=None) -> DataFrame:
    """The rows of a manifest, of some buckets or all."""
    schema = T.StructType.fromJson(manifest["schema"])
    folders = [f"{table}/{folder}" for bucket, parts in manifest["buckets"].items()
               if buckets is None or int(bucket) in buckets for folder in parts]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_parts(df: DataFrame, table: str, keys, buckets: int | None) -> dict[int, str]:
    """Rows put beside the table, unpublished: the folder of every bucket that has any."""
    spark, name = df.sparkSession, f"data/{uuid.uuid4().hex}"
    rows = df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
    rows.write.partitionBy(BUCKET).parquet(f"{table}/{name}")
    found = [str(s.getPath().getName()) for s in _listed(spark, f"{table}/{name}")]
    return {int(n.split("=")[1]): f"{name}/{n}" for n in found if n.startswith(f"{BUCKET}=")}


def drop_parts(spark: SparkSession, table: str, parts: dict[int, str]) -> None:
    """Removes folders of ``write_parts`` that no manifest names."""
    for folder in {p.rsplit("/", 1)[0] for p in parts.values()}:
        _drop(spark, table, folder)


def _drop(spark: SparkSession, table: str, folder: str) -> None:
    file_system(spark, table).delete(path_of(spark, f"{table}/{folder}"), True)


def publish(spark: SparkSession, table: str, manifest: dict) -> dict:
    """Makes a manifest the newest version. The rename either succeeds as a whole or fails because the number is taken."""
    fs = file_system(spark, table)
    draft = path_of(spark, f"{table}/versions/_draft-{uuid.uuid4().hex}")
    final = path_of(spark, f"{table}/versions/{manifest['version']:012d}.json")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(final).toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), spark.sparkContext._gateway.new_array(rename, 0))
    except Exception as failed:
        fs.delete(draft, False)
        if fs.exists(final):
            raise VersionTaken(f"{table} has a version {manifest['version']} already") from failed
        raise
    return manifest


def _following(manifest: dict | None, schema: T.StructType, keys, buckets: int, batch, notes=None) -> dict:
    """The manifest after this one, as yet with the same folders. ``notes`` are facts that change together with the rows."""
    old = manifest or {"version": 0, "buckets": {}, "batches": {}, "notes": {}}
    batches = {**old["batches"], batch[0]: batch[1]} if batch else old["batches"]
    return {"version": old["version"] + 1, "schema": schema.jsonValue(), "buckets": dict(old["buckets"]), "keys": list(keys),
            "n_buckets": buckets, "batches": batches, "notes": {**old["notes"], **(notes or {})}, "at": time.time()}


def applied(manifest: dict | None, batch) -> bool:
    """Whether a micro-batch, (stream, number), is in this version or an earlier one."""
    return bool(manifest and batch) and manifest["batches"].get(batch[0], -1) >= batch[1]


def _schema(manifest: dict | None, new: T.StructType) -> T.StructType:
    known = T.StructType.fromJson(manifest["schema"]).fields if manifest else []
    return T.StructType(known + [f for f in new.fields if f.name not in {k.name for k in known}])


def _buckets(manifest: dict | None, keys, buckets: int) -> int:
    if manifest and manifest["keys"] != list(keys):
        raise ValueError(f"the table is bucketed by {manifest['keys']}")
    return manifest["n_buckets"] if manifest else buckets


def append(df: DataFrame, table: str, keys, buckets: int | None = 64, batch=None, own: bool = False, notes: dict | None = None,
           attempts: int = 5) -> dict | None:
    """Adds rows without reading any. A ``batch`` (stream, number) that is in already adds nothing, so a micro-batch that is
    repeated counts once. In a table that is one stream's ``own``, the first batch of another stream starts from nothing: a
    stream that has lost its checkpoint reads its sources again. Returns the new manifest."""
    spark, manifest = df.sparkSession, snapshot(df.sparkSession, table)
    if applied(manifest, batch):
        return manifest
    n = _buckets(manifest, keys, buckets)
    parts = write_parts(df, table, keys, n)
    for _ in range(attempts):
        following = _following(manifest, _schema(manifest, df.schema), keys, n, batch, notes)
        if own and batch and manifest and batch[0] not in manifest["batches"]:
            following["buckets"], following["batches"] = {}, {batch[0]: batch[1]}
        for bucket, folder in parts.items():
            following["buckets"][str(bucket)] = [*following["buckets"].get(str(bucket), []), folder]
        try:
            return publish(spark, table, following)
        except VersionTaken:
            manifest = snapshot(spark, table)
            if applied(manifest, batch):
                break
    drop_parts(spark, table, parts)
    if applied(manifest, batch):
        return manifest
    raise VersionTaken(f"{table}: other writers were faster {attempts} times")


def merge(new: DataFrame, table: str, keys, combine: Callable[[DataFrame], DataFrame], buckets: int = 64, batch=None,
          notes: dict | None = None, attempts: int = 5) -> dict | None:
    """Replaces the buckets that ``new`` has rows of by ``combine`` of their stored and new rows (column ``_new``: 0 and 1). ``new``
    runs once: its rows are written first, as they come and not by bucket, which would be a shuffle more; their keys are then read
    to tell the buckets. Rows that ``combine`` leaves out are gone."""
    spark, manifest = new.sparkSession, snapshot(new.sparkSession, table)
    if applied(manifest, batch):
        return manifest
    n = _buckets(manifest, keys, buckets)
    name = f"data/{uuid.uuid4().hex}"
    new.write.parquet(f"{table}/{name}")
    try:
        fresh = spark.read.schema(new.schema).parquet(f"{table}/{name}")
        # At most one entry per bucket.
        touched = {r[0] for r in fresh.select(bucket_of(keys, n)).distinct().collect()}
        for _ in range(attempts):
            rows = fresh.withColumn("_new", F.lit(1))
            if manifest:
                old = read_snapshot(spark, table, manifest, touched).withColumn("_new", F.lit(0))
                rows = old.unionByName(rows, allowMissingColumns=True)
            merged = combine(rows).drop("_new")
            written = write_parts(merged, table, keys, n) if touched else {}
            following = _following(manifest, merged.schema, keys, n, batch, notes)
            for bucket in touched:
                following["buckets"].pop(str(bucket), None)
            following["buckets"].update({str(b): [folder] for b, folder in written.items()})
            try:
                return publish(spark, table, following)
            except VersionTaken:
                drop_parts(spark, table, written)
                manifest = snapshot(spark, table)
                if applied(manifest, batch):
                    return manifest
        raise VersionTaken(f"{table}: other writers were faster {attempts} times")
    finally:
        _drop(spark, table, name)


def compact(spark: SparkSession, table: str, combine: Callable[[DataFrame], DataFrame] | None = None, most: int = 8) -> dict | None:
    """Rewrites the buckets that consist of more than ``most`` folders, each as one, through ``combine`` if given (it must
    give the rows a reader would make of them anyway). Readers and the rows themselves notice nothing."""
    manifest = snapshot(spark, table)
    crowded = {int(b) for b, parts in manifest["buckets"].items() if len(parts) > most} if manifest else set()
    if not crowded:
        return manifest
    rows = read_snapshot(spark, table, manifest, crowded)
    written = write_parts(combine(rows) if combine else rows, table, manifest["keys"], manifest["n_buckets"])
    following = _following(manifest, T.StructType.fromJson(manifest["schema"]), manifest["keys"], manifest["n_buckets"], None)
    for bucket in crowded:
        following["buckets"].pop(str(bucket))
    following["buckets"].update({str(b): [folder] for b, folder in written.items()})
    try:
        return publish(spark, table, following)
    except VersionTaken:    # whoever was faster may leave the next compaction to a later call
        drop_parts(spark, table, written)
        return snapshot(spark, table)


def expire(spark: SparkSession, table: str, keep: int = 2, minutes: float = 60) -> int:
    """Removes all but the newest ``keep`` versions and every folder that no kept version names, as far as they are older than
    ``minutes``: time for readers that hold an old manifest and for writers that have not published. Returns how many folders went."""
    fs, limit = file_system(spark, table), (time.time() - 60 * minutes) * 1000
    known = versions(spark, table)
    for version in known[:-keep]:
        path = path_of(spark, f"{table}/versions/{version:012d}.json")
        if fs.getFileStatus(path).getModificationTime() <= limit:
            fs.delete(path, False)
    named = {folder.rsplit("/", 1)[0] for v in versions(spark, table) for parts in snapshot(spark, table, v)["buckets"].values()
             for folder in parts}
    gone = 0
    for status in _listed(spark, f"{table}/data"):
        if f"data/{status.getPath().getName()}" not in named and status.getModificationTime() <= limit:
            gone += bool(fs.delete(status.getPath(), True))
    return gone
