"""Ordered scans over long series without one task per key.

An oven, a channel or a year may hold a third of all rows, so a window over ``partitionBy(key)`` would put
that third into one task. The rows per key are counted first (map-side combined). If no key is large, the plain
window is used. Otherwise each key is cut into slices that respect the order: the window runs inside (key, slice), a
map-side combined aggregate gives one summary row per slice, and a window over the summaries carries the state from the
earlier slices in. Results are exact for any gap length.

Slices are fixed-width time slots. The summaries also count the rows; they are checkpointed (they are small), so
the fullest slice is known before the rows are shuffled. If it is over ``max_rows`` (a burst, or a clock that stamps
everything with the same instant) the rows are range-partitioned on (key, order) instead, which splits any group
evenly, and checkpointed, so that the slice numbers stay the same when tasks are repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cyclelake.functions.timing import time_slot
from cyclelake.session import shared_dir, staged

SLICE = "_slice"
KEY_ROWS = 1_000_000
MAX_SLICE_ROWS = 20_000_000


class OrderedSeries:
    """Rows of ``df`` ordered by ``order`` within ``keys``. ``order`` must be total; its first column is the
    one that slices are cut on: a timestamp (``width`` in minutes) or a number (``width`` in units). Keys with more
    than ``key_rows`` rows are cut, slices with more than ``max_rows`` are balanced."""

    def __init__(self, df: DataFrame, keys, order, width=60, max_rows=None, key_rows=None, numeric=False):
        self.keys, self.order, self.max_rows = list(keys), list(order), max_rows or MAX_SLICE_ROWS
        largest = df.groupBy(*self.keys).count().agg(F.max("count")).first()[0] or 0
        self.cut, self.balanced, self.df = largest > (key_rows or KEY_ROWS), False, df
        if self.cut:
            slot = F.floor(F.col(self.order[0]) / F.lit(width)) if numeric else time_slot(self.order[0], width)
            self.df = df.withColumn(SLICE, slot.cast("bigint"))
        self.by = [*self.keys, SLICE] if self.cut else self.keys
        self.window = W.partitionBy(*self.by).orderBy(*self.order)
        self.running = self.window.rowsBetween(W.unboundedPreceding, W.currentRow)
        self.position = F.struct(*self.order)

    def _summarise(self, columns: dict) -> DataFrame:
        """One checkpointed row per (key, slice), after the slices have been balanced where needed."""
        shared_dir(self.df.sparkSession)
        aggregates = [F.count(F.lit(1)).alias("_rows"), *[e.alias(n) for n, e in columns.items()]]
        summary = self.df.groupBy(*self.by).agg(*aggregates).checkpoint()
        if not self.balanced and (summary.agg(F.max("_rows")).first()[0] or 0) > self.max_rows:
            ranged = self.df.repartitionByRange(*[F.col(c) for c in self.keys + self.order]).checkpoint()
            self.df, self.balanced = ranged.withColumn(SLICE, F.spark_partition_id().cast("bigint")), True
            return self._summarise(columns)
        return summary

    def _scan(self, windowed: dict, summaries: dict, carry: dict) -> DataFrame:
        """The rows with the ``windowed`` columns and, when keys are cut, with what all earlier slices of the key hand
        over (otherwise null: nothing comes before the window)."""
        if not self.cut:
            return self.df.withColumns(windowed).withColumns({n: F.lit(None) for n in carry})
        before = W.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
        carried = self._summarise(summaries).select(*self.by, *[fn(before).alias(n) for n, fn in carry.items()])
        return self.df.withColumns(windowed).join(carried, self.by, "left").drop(SLICE)

    def with_previous(self, **columns) -> DataFrame:
        """``name=column``: value of ``column`` in the row before, null on the first row of a key."""
        values = F.struct(*[F.col(c).alias(name) for name, c in columns.items()])
        lagged = {name: F.lag(c).over(self.window) for name, c in columns.items()}
        if not self.cut:
            return self.df.withColumns(lagged)
        df = self._scan(
            {"_n": F.row_number().over(self.window), **lagged},
            {"_last": F.max_by(values, self.position)}, {"_carried_row": lambda w: F.last("_last").over(w)},
        )
        first = F.col("_n") == 1
        chosen = {n: F.when(first, F.col("_carried_row").getField(n)).otherwise(F.col(n)) for n in columns}
        return df.withColumns(chosen).drop("_n", "_carried_row")

    def with_last_seen(self, **columns) -> DataFrame:
        """``name=expression``: latest non-null value of the expression up to and including the row."""
        df = self._scan(
            {n: F.last(e, ignorenulls=True).over(self.running) for n, e in columns.items()},
            {f"_s_{n}": F.max_by(e, F.when(e.isNotNull(), self.position)) for n, e in columns.items()},
            {f"_c_{n}": lambda w, n=n: F.last(f"_s_{n}", ignorenulls=True).over(w) for n in columns},
        )
        return df.withColumns({n: F.coalesce(n, f"_c_{n}") for n in columns}).drop(*[f"_c_{n}" for n in columns])

    def with_extreme(self, name, expression, kind="max", inclusive=True) -> DataFrame:
        """Running max or min of ``expression`` over the rows up to (or strictly before) the row."""
        agg, pick = (F.max, F.greatest) if kind == "max" else (F.min, F.least)
        window = self.running if inclusive else self.window.rowsBetween(W.unboundedPreceding, -1)
        df = self._scan(
            {name: agg(expression).over(window)}, {"_s": agg(expression)}, {"_c": lambda w: agg("_s").over(w)}
        )
        return df.withColumn(name, pick(F.col(name), F.col("_c"))).drop("_c")

    def with_row_number(self, name) -> DataFrame:
        """Position of the row within its key, from 1."""
        number = F.row_number().over(self.window).cast("bigint")
        df = self._scan({name: number}, {}, {"_c": lambda w: F.sum("_rows").over(w)})
        return df.withColumn(name, F.col(name) + F.coalesce(F.col("_c"), F.lit(0))).drop("_c")


# Up to this rank Spark itself limits each key before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000


def first_n_per_key(df: DataFrame, keys, order, n: int, width=60) -> DataFrame:
    """The first n rows per key in ``order`` (column names), exact and without moving a whole hot key into one task:
    small n by a ranked window that Spark limits per map task, larger n by numbering the ordered series."""
    if n <= GROUP_LIMIT:
        ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    else:
        ranked = OrderedSeries(df, keys, order, width).with_row_number("_rank")
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def last_n_per_key(df: DataFrame, keys, order, n: int, width=60) -> DataFrame:
    """The last n rows per key in ``order``, in the same two ways."""
    if n <= GROUP_LIMIT:
        down = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
        return df.withColumn("_rank", F.row_number().over(down)).filter(F.col("_rank") <= n).drop("_rank")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    ranked = OrderedSeries(df, keys, order, width).with_row_number("_rank").join(sizes, list(keys))
    return ranked.filter(F.col("_rank") > F.col("_size") - n).drop("_rank", "_size")


def as_of_value(left, right, keys, left_order, right_order, value, name, inclusive=True, width=60,
                max_rows=None, key_rows=None) -> DataFrame:
    """``left`` plus ``name``: the value of the latest ``right`` row of the same keys at or before (strictly
    before when not ``inclusive``) the left row, null when there is none. Both sides are merged into one
    ordered series, so no pairs are built. ``left_order`` and ``right_order`` are (timestamp, id)."""
    rank = 0 if inclusive else 2
    marks = right.select(
        *keys, F.col(right_order[0]).alias("_ts"), F.lit(rank).alias("_side"),
        F.col(right_order[1]).cast("string").alias("_id"), F.struct(value.alias("v")).alias("_mark"),
    )
    asked = left.select(
        *keys, F.col(left_order[0]).alias("_ts"), F.lit(1).alias("_side"),
        F.col(left_order[1]).cast("string").alias("_id"), F.struct(*left.columns).alias("_row"),
    )
    # The series is read up to three times (rows per key, summaries, the scan), its sides may be costly.
    both = staged(asked.unionByName(marks, allowMissingColumns=True), "series")
    series = OrderedSeries(both, keys, ["_ts", "_side", "_id"], width, max_rows, key_rows)
    stamped = series.with_last_seen(_found=F.col("_mark")).filter(F.col("_side") == 1)
    return stamped.select("_row.*", F.col("_found.v").alias(name))
