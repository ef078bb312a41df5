"""Removal of byte strings that also start in a document with a smaller id, by suffix sorting.

1. Copies. Of documents with equal texts only those with the smallest id go on; the others are removed as a whole.
2. Screening. Texts are packed into slices. A window (a string of the length asked for) is known by the least hash of the
   16-byte strings in it, its anchor, and windows that are equal have equal anchors. Slices send each of their anchors once, as 32
   bits, to the fragment of the hash range, and fragments answer which ones other documents hold, too.
3. Sorting. Stretches of text around shared anchors go to the bucket of their anchor. Equal stretches become one; the windows
   of the rest are sorted as suffixes (deep-shallow), and equal neighbours tell the smallest document that holds each.
4. Anchors that very many documents hold (a line that a third of all texts repeat) would fill one bucket. Their windows are
   grouped as rows of their own instead, which Spark combines before the shuffle.
5. What was found goes back to the slices, which merge it and hash what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelake.llm.common import discard, staged, text_or_empty
from cyclelake.llm.deep_shallow import characters, sort_suffixes

GRAM = 16
SHALLOW = 32
BLOCK = 1_000_000              # windows that are hashed at a time
SLICE_BYTES = 2_000_000
FRAGMENT_BYTES = 64_000_000    # text behind a screening fragment
BUCKET_BYTES = 8_000_000       # text behind a bucket of stretches
LEAST_PARTS = 32
HOT = 30_000                   # documents that hold an anchor, from which its stretches are rows: some megabytes in a bucket
STRETCH = 64                   # windows of a stretch, at most
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)]
BLOB = "kind int, bucket bigint, slice bigint, anchors binary, docs binary, places binary, starts binary, lengths binary, data binary"
NO_BLOBS = ["anchors", "docs", "places", "starts", "lengths", "data"]


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    words = characters(text)
    out = (words[:-8] ^ (words[:-8] >> np.uint64(29))) * MIX[0] + words[8:]
    out = (out ^ (out >> np.uint64(32))) * MIX[1]
    return (out ^ (out >> np.uint64(29)))[:max(0, len(text) - GRAM + 1)]


def _runs_in_block(text: np.ndarray, low: int, starts: np.ndarray, ends: np.ndarray, limit: int):
    high = min(low + BLOCK, len(text))
    least, span, wanted = _gram_hashes(text[low:high + limit - 1]), 1, limit - GRAM + 1
    while span * 2 <= wanted:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    if span < wanted:
        least = np.minimum(least[:span - wanted], least[wanted - span:])
    first, last = np.searchsorted(ends, low, side="right"), np.searchsorted(starts, high)
    begins = np.maximum(starts[first:last], low)
    windows = np.maximum(0, np.minimum(ends[first:last] - limit + 1, high) - begins)
    doc = np.repeat(np.arange(first, last), windows)
    at = np.arange(len(doc)) + np.repeat(begins - np.cumsum(windows) + windows, windows)
    anchor = least[at - low]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))[:len(doc)]
    run = np.flatnonzero(new)
    # Least hashes are small numbers; mixed once more, they fill fragments evenly.
    mixed = anchor[run] * MIX[0]
    return (mixed ^ (mixed >> np.uint64(31))) * MIX[1], doc[run], at[run], np.diff(np.append(run, len(doc)))


def runs_of_anchors(text: np.ndarray, ends: np.ndarray, limit: int):
    """(anchor, doc, start, windows): the windows of concatenated documents, in runs of neighbours with one anchor. The work is
    done block by block, whatever the documents' lengths."""
    starts = np.append(0, ends[:-1])
    blocks = [_runs_in_block(text, low, starts, ends, limit) for low in range(0, max(1, len(text) - limit + 1), BLOCK)]
    return tuple(np.concatenate(column) for column in zip(*blocks))


def _distinct(anchors: np.ndarray, docs: np.ndarray):
    """The distinct anchors, sorted, and how many documents hold each; ``docs`` ascend."""
    order = np.argsort(anchors, kind="stable")
    a, d = anchors[order], docs[order]
    a = a[np.append(True, (a[1:] != a[:-1]) | (d[1:] != d[:-1]))[:len(a)]]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])[:len(a)])
    return a[first], np.diff(np.append(first, len(a)))


def _fragment(anchors: np.ndarray, fragments: int) -> np.ndarray:
    return ((anchors >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)


def _pack(fragments: int, limit: int):
    """Slices (fragment -1: ids, lengths, texts) and, per fragment, their anchors with the number of documents (up to 65,535)."""

    def rows(number, ids, texts):
        text, lengths = b"".join(texts), np.array([len(t) for t in texts], np.int64)
        anchors, docs, _, _ = runs_of_anchors(np.frombuffer(text, np.uint8), np.cumsum(lengths), limit)
        anchors, held = _distinct(anchors, docs)
        fragment = _fragment(anchors, fragments)
        first = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1])[:len(fragment)])
        cuts = list(zip(first, np.append(first[1:], len(fragment))))
        rest = (anchors & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        held = np.minimum(held, 65_535).astype(np.uint16)
        return pd.DataFrame({
            "part": [0, *[1] * len(first)], "slice": number, "fragment": [-1, *fragment[first].tolist()],
            "ids": [np.array(ids, np.int64).tobytes(), *[rest[a:b].tobytes() for a, b in cuts]],
            "lengths": [lengths.tobytes(), *[held[a:b].tobytes() for a, b in cuts]],
            "data": [text, *[None] * len(cuts)],
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, size, ids, texts = TaskContext.get().partitionId() << 32, 0, [], []
        for batch in batches:
            for doc_id, raw in zip(batch["_id"], batch["_raw"]):
                ids.append(doc_id)
                texts.append(raw)
                size += len(raw)
                if size >= SLICE_BYTES:
                    yield rows(number, ids, texts)
                    number, size, ids, texts = number + 1, 0, [], []
        if ids:
            yield rows(number, ids, texts)

    return run, "part int, slice bigint, fragment int, ids binary, lengths binary, data binary"


def _answers(group: pd.DataFrame) -> pd.DataFrame:
    """Per slice, for each anchor it sent: 1 where several documents hold it, 2 where more than HOT do."""
    parts = [np.frombuffer(x, np.uint32) for x in group["ids"]]
    rest = np.concatenate(parts)
    held = np.concatenate([np.frombuffer(x, np.uint16) for x in group["lengths"]]).astype(np.int64)
    order = np.argsort(rest, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(rest[order]) != 0))
    total = np.add.reduceat(held[order], first)
    code = np.empty(len(rest), np.uint8)
    code[order] = np.repeat((total > 1).astype(np.uint8) + (total > HOT), np.diff(np.append(first, len(rest))))
    cuts = np.cumsum([0, *[len(p) for p in parts]])
    return pd.DataFrame({"slice": group["slice"].to_numpy(), "fragment": group["fragment"].to_numpy(),
                         "codes": [code[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]})


def _gather(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    at = np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    return text[at]


def _equal_stretches(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For every stretch the number of the class of equal ones."""
    raw, known, out = text.tobytes(), {}, np.empty(len(starts), np.int64)
    for i, (a, n) in enumerate(zip(starts.tolist(), lengths.tolist())):
        out[i] = known.setdefault(raw[a:a + n], len(known))
    return out


def _least(classes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    least = np.full(int(classes.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, classes, docs)
    return least


def _stretches(buckets: int, limit: int):
    """Of a slice: the stretches around shared anchors, by bucket. Of stretches that are equal in the slice those of the smallest
    document go; the others are found at once (kind 1: triples place, start, end)."""

    def run(key, slices: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = slices.iloc[0]
        text, ids = np.frombuffer(row["data"], np.uint8), np.frombuffer(row["ids"], np.int64)
        ends = np.cumsum(np.frombuffer(row["lengths"], np.int64))
        anchors, docs, starts, windows = runs_of_anchors(text, ends, limit)
        sent, _ = _distinct(anchors, docs)
        codes = np.frombuffer(b"".join(answers.sort_values("fragment")["codes"]), np.uint8)
        code = codes[np.searchsorted(sent, anchors)]
        anchors, docs, starts, windows, code = (x[code > 0] for x in (anchors, docs, starts, windows, code))
        pieces = -(-windows // STRETCH)
        owner = np.repeat(np.arange(len(pieces)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        anchors, docs, code, starts = anchors[owner], docs[owner], code[owner], starts[owner] + nth * STRETCH
        windows = np.minimum(windows[owner] - nth * STRETCH, STRETCH)
        lengths = windows + limit - 1
        classes = _equal_stretches(text, starts, lengths)
        later = ids[docs] > _least(classes, ids[docs])[classes]
        own = starts - np.append(0, ends)[docs]
        found = np.stack([docs, own, own + lengths], axis=1)[later]
        out = [(1, -1, found.astype(np.int64).tobytes(), *[None] * 5)]
        # Hot anchors have buckets of their own, which stay rows (kind 2).
        bucket = np.where(code == 2, -1, (anchors % np.uint64(buckets)).astype(np.int64))
        order = np.flatnonzero(~later)[np.argsort(bucket[~later], kind="stable")]
        cuts = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])[:len(order)])
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            rows = order[a:b]
            number = int(bucket[rows[0]])
            out.append((0 if number >= 0 else 2, number, anchors[rows].tobytes(), ids[docs[rows]].tobytes(),
                        docs[rows].astype(np.int64).tobytes(), own[rows].astype(np.int64).tobytes(),
                        lengths[rows].astype(np.int64).tobytes(), _gather(text, starts[rows], lengths[rows]).tobytes()))
        return pd.DataFrame(out, columns=["kind", "bucket", *NO_BLOBS]).assign(slice=key[0])[
            ["kind", "bucket", "slice", *NO_BLOBS]]

    return run


def _joined(group: pd.DataFrame, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(group[column]), kind)


def _sorted_bucket(limit: int):
    """Per slice the triples that the stretches of one bucket show to be held by a smaller document."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        anchors, docs = _joined(group, "anchors", np.uint64), _joined(group, "docs", np.int64)
        places, own = _joined(group, "places", np.int64), _joined(group, "starts", np.int64)
        lengths, text = _joined(group, "lengths", np.int64), _joined(group, "data", np.uint8)
        starts = np.cumsum(lengths) - lengths
        classes = _equal_stretches(text, starts, lengths)
        least = _least(classes, docs)
        later = docs > least[classes]
        found = [np.stack([np.flatnonzero(later), own[later], (own + lengths)[later]], axis=1)]
        # One stretch of each class; anchors that only one class has need no sorting.
        one = np.unique(classes, return_index=True)[1]
        several = np.unique(anchors[one], return_counts=True)
        one = one[np.isin(anchors[one], several[0][several[1] > 1])]
        windows = lengths[one] - limit + 1
        stretch = np.repeat(np.arange(len(one)), windows)
        offset = np.arange(len(stretch)) - np.repeat(np.cumsum(windows) - windows, windows)
        order, new = sort_suffixes(text, starts[one][stretch] + offset,
                                   np.unique(anchors[one], return_inverse=True)[1][stretch], limit, min(SHALLOW, limit // 8 * 8))
        if len(order):
            # Back from places in the text to stretches; equal suffixes are neighbours.
            holder = np.searchsorted(starts, order, side="right") - 1
            first = np.flatnonzero(new)
            smallest = np.repeat(np.minimum.reduceat(least[classes[holder]], first), np.diff(np.append(first, len(order))))
            removed = np.zeros(len(text), bool)
            removed[order[smallest < least[classes[holder]]]] = True
            # The rows of the class's smallest document, copies of the stretch inside it included.
            kept = np.flatnonzero(~later)
            kept = kept[np.isin(classes[kept], classes[one])]
            where = np.empty(len(least), np.int64)
            where[classes[one]] = starts[one]
            count = lengths[kept] - limit + 1
            row = np.repeat(kept, count)
            shift = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            hit = removed[where[classes[row]] + shift]
            row, shift = row[hit], shift[hit]
            begins = np.append(True, (row[1:] != row[:-1]) | (shift[1:] != shift[:-1] + 1))[:len(row)]
            stops = np.append(begins[1:], True)[:len(row)]
            found.append(np.stack([row[begins], (own[row] + shift)[begins], (own[row] + shift)[stops] + limit], axis=1))
        found = np.concatenate(found)
        slices = np.repeat(group["slice"].to_numpy(), [len(x) // 8 for x in group["anchors"]])
        return _by_slice(slices[found[:, 0]], places[found[:, 0]], found[:, 1], found[:, 2])

    return run


def _by_slice(slices, places, begins, ends) -> pd.DataFrame:
    order = np.argsort(slices, kind="stable")
    slices = slices[order]
    triples = np.stack([places, begins, ends], axis=1).astype(np.int64)[order]
    cuts = np.flatnonzero(np.append(True, slices[1:] != slices[:-1])[:len(slices)])
    return pd.DataFrame({"slice": slices[cuts].astype(np.int64),
                         "anchors": [triples[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(slices)))]})


def _stretch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            lengths = np.frombuffer(row.lengths, np.int64)
            ends = np.cumsum(lengths)
            yield pd.DataFrame({
                "stretch": [row.data[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist())],
                "doc": np.frombuffer(row.docs, np.int64), "slice": row.slice, "place": np.frombuffer(row.places, np.int64),
                "start": np.frombuffer(row.starts, np.int64)})


def _hot_windows(stretches: DataFrame, limit: int) -> DataFrame:
    """(slice, anchors: triples) of what starts in a smaller document, too, at hot anchors. A stretch that a smaller document
    holds as a whole is gone as a whole; only those of the smallest documents are taken apart into windows."""
    rows = staged(stretches.filter("kind = 2").select("slice", "docs", "places", "starts", "lengths", "data").mapInPandas(
        _stretch_rows, "stretch binary, doc bigint, slice bigint, place bigint, start bigint"), "hot")
    least = staged(rows.groupBy("stretch").agg(F.min("doc").alias("least")), "hot_least")
    known = rows.join(least, "stretch")
    end = F.col("start") + F.octet_length("stretch")
    whole = known.filter(F.col("doc") > F.col("least")).select("slice", "place", "start", end.alias("end"))
    first = known.filter(F.col("doc") == F.col("least"))
    windows = staged(first.select("doc", "slice", "place", "start", "stretch", F.explode(
        F.sequence(F.lit(0), F.octet_length("stretch") - limit)).alias("at")).select(
        F.substring("stretch", F.col("at") + 1, F.lit(limit)).alias("window"), "doc", "slice", "place",
        (F.col("start") + F.col("at")).alias("start")), "windows")
    held = windows.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    shared = staged(held.filter("least < most").select("window", "least"), "shared_windows")
    parts = windows.join(shared, "window").filter(F.col("doc") > F.col("least")).select(
        "slice", "place", "start", (F.col("start") + limit).alias("end"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield _by_slice(*(b[c].to_numpy() for c in ("slice", "place", "start", "end")))

    return whole.unionByName(parts).mapInPandas(pack, "slice bigint, anchors binary")


def _merged(triples: np.ndarray) -> np.ndarray:
    """Maximal runs (place, start, end): ranges of one document that overlap or touch are one."""
    triples = triples[np.lexsort((triples[:, 1], triples[:, 0]))]
    place, start, end = triples.T
    # Ends may only grow within a document; places lift them apart.
    lift = place * (end.max(initial=0) + 1)
    reach = np.maximum.accumulate(end + lift)
    new = np.append(True, start[1:] + lift[1:] > reach[:-1])[:len(place)]
    first = np.flatnonzero(new)
    return np.stack([place[first], start[first], np.maximum.reduceat(end, first) if len(first) else end], axis=1)


def _results(key, slices: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    row = slices.iloc[0]
    ids, lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"], np.int64)
    starts = np.cumsum(lengths) - lengths
    runs = _merged(_joined(found, "anchors", np.int64).reshape(-1, 3))
    cuts = np.searchsorted(runs[:, 0], np.arange(len(ids) + 1))
    out = []
    for i, (doc_id, start, length) in enumerate(zip(ids.tolist(), starts.tolist(), lengths.tolist())):
        begins, ends = runs[cuts[i]:cuts[i + 1], 1], runs[cuts[i]:cuts[i + 1], 2]
        text = row["data"][start:start + length]
        kept = [text[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), length])]
        out.append((doc_id, length, begins, ends, b"".join(kept)))
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "starts", "ends", "kept"])


def remove_repeats(df: DataFrame, limit: int = 50, id_column="doc_id", text="text") -> DataFrame:
    """doc_id, n_bytes, starts, ends, kept: one row per input row, with the maximal removed runs (byte offsets) and the bytes that
    are left.

    A byte is removed when a string of ``limit`` bytes (at least 16) that covers it also starts in a document with a smaller id.
    Texts are compared as UTF-8 bytes, whole and however long; null texts are empty. Texts shorter than ``limit`` keep all. Rows
    without an id remove nothing and keep all; rows that share an id (ids are whole numbers) remove nothing from each other.
    Repeated rows give repeated results. An empty table gives no rows. Other columns are not read.
    """
    if limit < GRAM:
        raise ValueError(f"strings of fewer than {GRAM} bytes are not supported")
    rows = df.select(F.col(id_column).cast("bigint").alias("_id"), F.encode(text_or_empty(text), "utf-8").alias("_raw"))
    rows = rows.withColumn("n", F.octet_length("_raw").cast("bigint"))
    taking = (F.col("n") >= limit) & F.col("_id").isNotNull()
    none = F.array().cast("array<bigint>")
    short = rows.filter(~taking).select(F.col("_id").alias("doc_id"), F.col("n").alias("n_bytes"), none.alias("starts"),
                                        none.alias("ends"), F.col("_raw").alias("kept"))
    known = staged(rows.filter(taking).select("_id", "n", F.unhex(F.sha2("_raw", 256)).alias("sha")), "texts")
    first = staged(known.groupBy("sha").agg(F.min("_id").alias("_id"), F.max("n").alias("n")), "first")
    copies = known.join(first.select("sha", F.col("_id").alias("least")), "sha").filter(F.col("_id") > F.col("least")).select(
        F.col("_id").alias("doc_id"), F.col("n").alias("n_bytes"), F.array(F.lit(0).cast("bigint")).alias("starts"),
        F.array("n").alias("ends"), F.lit(b"").alias("kept"))
    size = first.agg(F.sum("n")).first()[0] or 0
    fragments, buckets = (max(LEAST_PARTS, -(-size // b)) for b in (FRAGMENT_BYTES, BUCKET_BYTES))
    texts = rows.filter(taking).withColumn("sha", F.unhex(F.sha2("_raw", 256))).join(
        first.select("_id", "sha"), ["_id", "sha"], "left_semi").select("_id", "_raw")
    packed = staged(texts.mapInPandas(*_pack(fragments, limit)), "slices", "part")
    slices = packed.filter("part = 0").select("slice", "ids", "lengths", "data")
    answers = staged(packed.filter("part = 1").select("slice", "fragment", "ids", "lengths").groupBy("fragment").applyInPandas(
        _answers, "slice bigint, fragment int, codes binary"), "answers")
    discard(packed, "part=1")
    stretches = staged(slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInPandas(
        _stretches(buckets, limit), BLOB), "stretches")
    discard(answers)
    found = stretches.filter("kind = 1").select("slice", "anchors")
    found = found.unionByName(stretches.filter("kind = 0").groupBy("bucket").applyInPandas(
        _sorted_bucket(limit), "slice bigint, anchors binary"))
    found = staged(found.unionByName(_hot_windows(stretches, limit)), "found")
    discard(stretches)
    done = slices.groupBy("slice").cogroup(found.groupBy("slice")).applyInPandas(
        _results, "doc_id bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary")
    return short.unionByName(copies).unionByName(done)


def repeats_report(df: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``remove_repeats``."""
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda x, y: x + y)
    return remove_repeats(df, **options).select("doc_id", "n_bytes", removed.alias("n_removed"),
                                                F.size("starts").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
