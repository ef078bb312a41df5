"""Mixing sources to target weights by nested hash thresholds.

Every document has a fixed 48-bit hash. Words are summed by source and the hash's first 12 bits; a source's budget falls
into one bucket, and only that bucket's documents are summed again by their next 12 bits, until the budget falls on one
hash value. Documents below it are taken once more than the others. Nothing is sorted, and the only tables that are not
spread over all tasks hold one row per source or per source and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cyclelake.llm.common import staged, word_count

BITS, LEVELS = 12, 4


def _hash(id_column: str) -> Column:
    """48 bits of a digest that every engine computes alike."""
    digest = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights, share: float, most: int) -> DataFrame:
    """_source, source_size, target for a table of (_source, size). Sources by code point, null last, take the weights in
    turn; targets add up to ``share`` of all words and stop at ``most`` times the source's size, the excess going to
    the others by weight. The result is the water level at which the first source in order of size / weight is not
    full. One row per source, so its two windows run in one task."""
    by_source = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(F.asc_nulls_last("_source"))) - 1) % len(weights)
    weighted = by_source.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("bigint"))
    capped = weighted.withColumn("_cap", (most * F.col("source_size")).cast("bigint"))
    order = W.orderBy(F.col("_cap") / F.col("_weight"), F.asc_nulls_last("_source"))
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    leveled = capped.withColumn("_n", F.row_number().over(order)).withColumn(
        "_cap_before", F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_cap"))
    total = F.sum("source_size").over(everything)
    after = F.sum("_weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    level = (F.lit(share) * total - F.col("_cap_before")) / after
    leveled = leveled.withColumn("_level", level)
    free = F.when(F.col("_cap") / F.col("_weight") > F.col("_level"), F.col("_n"))
    leveled = leveled.withColumn("_level", F.min_by("_level", free).over(everything))
    target = F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap")))
    return leveled.select("_source", "source_size", target.alias("target"))


def _with_state(docs: DataFrame, state: DataFrame) -> DataFrame:
    """``docs`` with its source's row. The state's size is known from its files, so it is broadcast only when it is
    small; else skewed sources are split by the optimizer."""
    joined = docs.alias("d").join(state.alias("s"), F.col("d._source").eqNullSafe(F.col("s._source")))
    return joined.select("d.*", *[f"s.{c}" for c in state.columns if c != "_source"])


def _thresholds(sizes: DataFrame, weights, share: float, most: int) -> DataFrame:
    """One row per source: _whole copies of everything, and what is left to take (_rest) ends in the hash value _at,
    which holds _words."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = source_targets(sizes, weights, share, most).withColumn("_whole", whole.cast("bigint"))
    state = staged(targets.select("*", (F.col("target") - F.col("_whole") * F.col("source_size")).alias("_rest"),
                                  F.lit(0).cast("bigint").alias("_at")), "mix")
    for level in range(1, LEVELS + 1):
        prefix = F.shiftright("_hash", BITS * (LEVELS - level))
        inside = _with_state(sizes, state.select("_source", "_at")).filter(F.shiftright(prefix, BITS) == F.col("_at"))
        buckets = inside.groupBy("_source", prefix.alias("_bucket")).agg(F.sum("size").alias("_words"))
        up_to = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        cumulated = _with_state(buckets.withColumn("_to", F.sum("_words").over(up_to)), state.select("_source", "_rest"))
        ends = cumulated.filter(F.col("_to") > F.col("_rest")).groupBy("_source").agg(
            F.min_by(F.struct("_bucket", "_to", "_words"), "_bucket").alias("_end"))
        joined = state.alias("s").join(ends.alias("e"), F.col("s._source").eqNullSafe(F.col("e._source")), "left")
        state = staged(joined.select(
            "s._source", "source_size", "target", "_whole", F.col("_end._bucket").alias("_at"),
            (F.col("_rest") - F.coalesce(F.col("_end._to") - F.col("_end._words"), F.lit(0))).alias("_rest"),
            F.col("_end._words").alias("_words")), "mix")
    return state


def _copies() -> Column:
    closer = F.col("_words") - F.col("_rest") < F.col("_rest")
    below = (F.col("_hash") < F.col("_at")) | ((F.col("_hash") == F.col("_at")) & closer)
    return F.col("_whole") + F.coalesce(below, F.lit(False)).cast("int")


def _sized(df: DataFrame, id_column: str, text: str, source: str) -> DataFrame:
    return staged(df.select(F.col(id_column).alias("_id"), F.col(source).alias("_source"),
                            word_count(text).alias("size"), _hash(id_column).alias("_hash")), "sizes")


def taken_words(df: DataFrame, weights=(5, 2, 1), share=1.5, most=2, id_column="doc_id", text="text",
                source="source") -> DataFrame:
    """id, size, source_size, target, taken, copies: one row per input row.

    A source whose target is k sizes and a rest is taken k times, and its documents with the smallest hashes once
    more; the document on which the rest ends is taken when that comes closer to the target. ``copies`` is at most
    ``most``. Null texts have no words; null sources are one source; rows with equal ids are taken alike; without any
    words all targets are 0; other columns are not read.
    """
    sizes = _sized(df, id_column, text, source)
    taken = _with_state(sizes, _thresholds(sizes, weights, share, most)).withColumn("copies", _copies())
    return taken.select(F.col("_id").alias(id_column), "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(df: DataFrame, weights=(5, 2, 1), share=1.5, most=2, id_column="doc_id", text="text",
        source="source") -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it (see ``taken_words``). Texts are not shuffled unless the
    table of sources is large."""
    state = _thresholds(_sized(df, id_column, text, source), weights, share, most)
    rows = df.select(F.struct(*df.columns).alias("_row"), F.col(source).alias("_source"),
                     _hash(id_column).alias("_hash"))
    repeated = _with_state(rows, state).select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.when(
        _copies() > 0, _copies()))).alias("_copy"))
    return repeated.select("_row.*")
