"""Toxicity by a weighted lexicon that is matched with an Aho-Corasick automaton.

Texts are folded first: letters of other scripts that look like Latin ones, and digits and signs that stand for letters,
become those letters; everything that is no letter becomes a blank. The lexicon holds words and word beginnings that are
far more frequent in documents labelled toxic, with their log odds as weights. Matches inside an exception phrase do not
count. A document is scored from its matched weight, as such and normalised by its length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cyclelake.llm.common import release_memory, is_held_out, staged, text_or_empty
from cyclelake.llm.samples import logistic, sampled_ids, sampled_texts, sigmoid

TOXIC, CLEAN = 4_000, 8_000   # labelled documents the lexicon is learned from, at most
REJECT = 0.5
ENTRIES = 5_000               # of the lexicon, at most
BEGINNINGS = (4, 5, 6)        # letters of a word beginning
LEAST_WEIGHT, LEAST_EVIDENCE = 3.0, 16.0
LEAST_SPARE = 30              # toxic documents that are enough to weigh the measures on
BANDS, BAND_HASHES = 16, 3    # near copies are looked for among documents that agree on all hashes of a band
SAME_WORDS = 0.5              # of all distinct words of two near copies
FLUSH = 200_000               # entries a task counts before it hands them on
# Letters and signs that look like the Latin letter they stand for.
LOOKALIKES = {
    "а": "a", "α": "a", "ɑ": "a", "@": "a", "4": "a", "в": "b", "β": "b", "8": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e",
    "ε": "e", "є": "e", "3": "e", "ɡ": "g", "9": "g", "һ": "h", "н": "h", "і": "i", "ι": "i", "ı": "i", "1": "i", "ј": "j",
    "к": "k", "κ": "k", "ӏ": "l", "м": "m", "ո": "n", "η": "n", "о": "o", "ο": "o", "σ": "o", "0": "o", "р": "p", "ρ": "p",
    "ԛ": "q", "г": "r", "ѕ": "s", "$": "s", "5": "s", "т": "t", "τ": "t", "7": "t", "υ": "u", "ս": "u", "ν": "v", "ѵ": "v",
    "ѡ": "w", "ω": "w", "х": "x", "χ": "x", "у": "y", "γ": "y", "2": "z",
}
# Harmless phrases that hold words of abuse.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "circus clown", "clown fish", "class clown", "sore loser")


class _Fold(dict):
    """What each character becomes, worked out when it is first met."""

    def __missing__(self, code: int) -> str:
        plain = unicodedata.normalize("NFKC", chr(code)).casefold()
        value = "".join(LOOKALIKES.get(c, c if c.isalpha() or unicodedata.combining(c) else " ") for c in plain)
        self[code] = value
        return value


_FOLD = _Fold()


def fold(text: str) -> str:
    """The text as blank-separated folded words, with a blank at both ends."""
    return f" {text.translate(_FOLD)} "


def entries_of(folded: str) -> set[str]:
    """Lexicon candidates of a folded text: its words (with a blank at both ends) and beginnings (one in front)."""
    words = {w for w in folded.split(" ") if len(w) > 2}
    found = {f" {w} " for w in words}
    for size in BEGINNINGS:
        found.update(f" {w[:size]}" for w in words if len(w) > size)
    return found


@dataclass(frozen=True)
class ToxicityModel:
    """Weighted entries, exception phrases (folded) and the coefficients of the three measures of a document."""

    entries: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    beta: tuple[float, ...]

    @cached_property
    def automaton(self):
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), 0.0))
        for entry, weight in self.entries:
            found.add_word(entry, (len(entry), weight))
        found.make_automaton()
        return found

    def __getstate__(self):
        return {"entries": self.entries, "exceptions": self.exceptions, "beta": self.beta}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def measures(self, text: str) -> tuple[float, float, float]:
        """Matched weight (its logarithm), per word and per square root of words."""
        if not self.entries:
            return 0.0, 0.0, 0.0
        matches = [(end - size, end, weight) for end, (size, weight) in self.automaton.iter(fold(text))]
        if not matches:
            return 0.0, 0.0, 0.0
        harmless = [(a, b) for a, b, w in matches if w == 0.0]
        total = sum(w for a, b, w in matches if w and not any(x <= a and b <= y for x, y in harmless))
        words = len(text.split()) or 1
        return float(np.log1p(total)), total / words, total / np.sqrt(words)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.array([self.measures(t) for t in texts])
        return sigmoid(x @ np.array(self.beta[:-1]) + self.beta[-1])


def _count_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[dict, dict] = ({}, {})

    def rows():
        frames = [pd.DataFrame({"entry": list(c), "toxic": list(c.values()) if k else 0, "clean": 0 if k else list(c.values())})
                  for k, c in enumerate(counts) if c]
        for c in counts:
            c.clear()
        return frames

    for batch in batches:
        for toxic, text in zip(batch["_toxic"], batch["_text"]):
            own = counts[int(toxic)]
            for entry in entries_of(fold(text)):
                own[entry] = own.get(entry, 0) + 1
            if len(own) > FLUSH:
                yield from rows()
    yield from rows()


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """BANDS rows per document: the band, a hash of the band's BAND_HASHES independent minimum hashes of its words, and one
    more minimum hash."""
    factors = np.random.default_rng(1).integers(1, 1 << 63, BANDS * BAND_HASHES + 1, np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        rows = []
        for own, toxic, text in zip(batch["_id"], batch["_toxic"], batch["_text"]):
            words = np.array([xxhash.xxh3_64_intdigest(w) for w in {"", *text.lower().split()}], np.uint64)
            least = (words[:, None] * factors).min(0)
            bands = least[:-1].reshape(BANDS, BAND_HASHES)
            rows += [(own, toxic, n, xxhash.xxh3_64_intdigest(b.tobytes()) >> 1, int(least[-1] >> np.uint64(1))) for n, b in enumerate(bands)]
        yield pd.DataFrame(rows, columns=["_id", "_toxic", "_band", "_key", "_order"])


def _one_per_family(sample: DataFrame) -> DataFrame:
    """The sample without near copies, whose rare words would look like evidence: of two documents of one class that have at
    least SAME_WORDS of their distinct words in common, the one with the larger id goes. Documents are compared when all
    minimum hashes of one band agree; sharing single words is not enough for anything."""
    id_type = sample.schema["_id"].dataType.simpleString()
    signed = sample.select("_id", "_toxic", "_text").mapInPandas(
        _signatures, f"_id {id_type}, _toxic int, _band int, _key bigint, _order bigint")
    group = W.partitionBy("_toxic", "_band", "_key").orderBy("_order", "_id")
    near = signed.select("_id", F.first("_id").over(group).alias("_first"), F.lag("_id").over(group).alias("_last"))
    pairs = near.select("_id", F.explode(F.array("_first", "_last")).alias("_other")).filter("_id <> _other")
    pairs = pairs.select(F.greatest("_id", "_other").alias("_id"), F.least("_id", "_other").alias("_other")).distinct()
    words = sample.select("_id", F.array_distinct(F.split(F.lower(F.btrim("_text")), "\\s+")).alias("_words"))
    both = pairs.join(words, "_id").join(words.select(F.col("_id").alias("_other"), F.col("_words").alias("_others")), "_other")
    common = F.size(F.array_intersect("_words", "_others"))
    copies = both.filter(common >= SAME_WORDS * (F.size("_words") + F.size("_others") - common)).select("_id").distinct()
    return sample.join(F.broadcast(copies), "_id", "left_anti")


def _evidence(t: Column, c: Column, toxic: int, clean: int) -> Column:
    """Log-likelihood ratio of an entry's counts against equal frequencies in both classes."""
    share = toxic / (toxic + clean)

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    return 2 * (part(t, (t + c) * share) + part(c, (t + c) * (1 - share)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, toxic=TOXIC, clean=CLEAN, exceptions=EXCEPTIONS, id_column="doc_id",
                 text="text", label="toxic") -> ToxicityModel:
    """A model from at most ``toxic`` documents labelled 1 and ``clean`` ones labelled 0, outside the held-out fifth.
    Entries are counted in tasks; the driver gets the lexicon (at most ENTRIES) and three numbers per document."""
    ids = sampled_ids(labels.filter(F.col(label) == 1), toxic, id_column).withColumn("_toxic", F.lit(1)).unionByName(
        sampled_ids(labels.filter(F.col(label) == 0), clean, id_column).withColumn("_toxic", F.lit(0)))
    ids = ids.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    every = sampled_texts(docs, ids, id_column, text)
    every = staged(every.withColumn("_spare", F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(4)) == 0), "sample")
    sample = staged(_one_per_family(every.filter(~F.col("_spare"))), "families")
    sizes = {r["_toxic"]: r["n"] for r in sample.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    folded = tuple(fold(x) for x in exceptions)
    if not n_toxic or not n_clean:
        return ToxicityModel((), folded, (0.0, 0.0, 0.0, -20.0 if n_clean else 0.0))
    counted = sample.mapInPandas(_count_entries, "entry string, toxic bigint, clean bigint").groupBy("entry").agg(
        F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    t, c = F.col("t"), F.col("c")
    weight = F.log((t + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))
    strong = counted.filter(t >= max(3, n_toxic // 200)).withColumn("weight", weight).withColumn(
        "evidence", _evidence(t, c, n_toxic, n_clean))
    strong = strong.filter((F.col("weight") >= LEAST_WEIGHT) & (F.col("evidence") >= LEAST_EVIDENCE))
    kept: dict[str, float] = {}
    for row in sorted(strong.orderBy(F.desc("evidence"), "entry").limit(ENTRIES).collect(), key=lambda r: (len(r.entry), r.entry)):
        beginnings = [kept[row.entry[:size + 1]] for size in BEGINNINGS if row.entry[:size + 1] in kept]
        if not beginnings or max(beginnings) < row.weight - 1:   # else a beginning says the same
            kept[row.entry] = row.weight
    lexicon = ToxicityModel(tuple(sorted(kept.items())), folded, (0.0, 0.0, 0.0, 0.0))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([lexicon.measures(s) for s in batch["_text"]]).reshape(-1, 3)
            yield pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "toxic": batch["_toxic"].to_numpy(),
                                "spare": batch["_spare"].to_numpy()})

    rows = every.mapInPandas(measure, "a double, b double, c double, toxic int, spare boolean").toPandas()
    rows = rows.sort_values(["a", "b", "c", "toxic", "spare"])
    # The measures are weighed on documents that the lexicon was not learned from, if there are enough.
    if rows[rows["spare"]]["toxic"].sum() >= LEAST_SPARE:
        rows = rows[rows["spare"]]
    beta = logistic(rows[["a", "b", "c"]].to_numpy(), rows["toxic"].to_numpy(float), np.ones(len(rows)), ridge=1e-3)
    return ToxicityModel(lexicon.entries, folded, tuple(float(b) for b in beta))


def toxicity_score(model: ToxicityModel, text="text") -> Column:
    """Score of a text from 0 to 1. Null texts are empty ones."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts.tolist()), dtype="float64")
        _FOLD.clear()
        release_memory()

    return score(text_or_empty(text))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_column="doc_id", text="text", **options) -> DataFrame:
    """id, held_out, score, predicted (1 if score >= 0.5): one row per input row. Null and empty texts are scored like
    others, repeated rows alike; rows without an id are not held out and teach nothing. Without toxic and clean labels
    nothing is known: the score is 0.5, or near 0 when all labels are clean. Other columns are not read."""
    model = fit_toxicity(docs, labels, id_column=id_column, text=text, **options)
    scored = docs.select(id_column, is_held_out(id_column).alias("held_out"), toxicity_score(model, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not rejected, as they are: null texts count as empty ones, repeated rows stay or go together,
    ties with the threshold go, an empty table stays empty. Texts are read whole."""
    model = fit_toxicity(docs, labels, **options)
    return docs.filter(toxicity_score(model, options.get("text", "text")) < REJECT)
