"""Joins of a long table with a table that holds one row per key, when a key may hold a large share of the rows.

The optimizer splits skewed join partitions only between two plain shuffles, not where one side is an aggregate.
So the heavy keys are found first with a map-side combined count. There are at most ``rows / HOT_ROWS`` of them, which
bounds what is broadcast: their rows take their match from the broadcast and go through the shuffle under a spread-out
key; all other rows meet the table in an ordinary join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelake.session import shared_dir

HOT_ROWS = 5_000_000
SPREAD = 1_000_000
SMALL_ROWS = 1_000_000
PROBE = "probe"


def hot_keys(df: DataFrame, key: str, max_rows: int | None = None) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows, or None when there are none (the usual case)."""
    shared_dir(df.sparkSession)
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counted.filter(F.col("_rows") > (max_rows or HOT_ROWS)).select(key).checkpoint()
    return None if hot.isEmpty() else hot


def join_per_key(
    df: DataFrame, table: DataFrame, key: str, how: str = "inner", spread_by: str = "reading_id",
    hot: DataFrame | None | str = PROBE,
) -> DataFrame:
    """``df`` joined (inner, left or left_semi) with ``table``, which holds one row per key. ``spread_by`` is a column
    of ``df`` with many values. ``hot`` holds the heavy keys where they are known (None: there are none), for example
    from a cheaper table that holds at least these rows; otherwise they are counted in ``df``."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"join type {how!r} is not supported")
    if isinstance(hot, str):
        hot = hot_keys(df, key)
    if hot is None:
        return df.join(table, key, how)
    added = [c for c in table.columns if c != key]
    packed = table.select(key, F.struct(F.lit(True).alias("_hit"), *added).alias("_row"))
    heavy = hot.join(packed, key, "left").select(key, F.lit(True).alias("_hot"), F.col("_row").alias("_hot_row"))
    marked = df.join(F.broadcast(heavy), key, "left")
    # Rows without a key (idle readings) never match and are spread as well.
    spread = F.col("_hot") | F.col(key).isNull()
    salt = F.when(spread, 1 + F.pmod(F.xxhash64(spread_by), F.lit(SPREAD))).otherwise(F.lit(0).cast("bigint"))
    # Always 0, but not a literal: a literal would be folded out of the join keys and with it the spreading.
    unsalted = packed.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1).cast("bigint")))
    joined = marked.withColumn("_salt", salt).join(unsalted, [key, "_salt"], "left")
    joined = joined.withColumn("_row", F.coalesce("_hot_row", "_row"))
    if how != "left":
        joined = joined.filter(F.col("_row").isNotNull())
    if how == "left_semi":
        return joined.select(*df.columns)
    return joined.select(*df.columns, *[F.col("_row").getField(c).alias(c) for c in added])


def join_dimension(df: DataFrame, table: DataFrame, key: str, how: str = "inner", spread_by: str = "reading_id") -> DataFrame:
    """``df`` joined (inner, left or left_semi) with a table of one row per ``key`` that is usually small: ovens, materials. The
    table is computed once and counted. Up to ``SMALL_ROWS`` rows it is broadcast, so ``df`` is not shuffled and a key that
    holds a third of it does no harm; beyond that ``join_per_key`` splits the heavy keys."""
    shared_dir(df.sparkSession)
    kept = table.checkpoint()
    if kept.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return df.join(F.broadcast(kept), key, how)
    return join_per_key(df, kept, key, how, spread_by)
