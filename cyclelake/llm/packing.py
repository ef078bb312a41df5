"""Hierarchical packing of documents into training sequences of several context sizes.

Each task packs the documents it reads, so nothing is shuffled and memory holds a bounded number of documents. Whole
4096-token windows are cut from long documents; what is left of a document goes to the smallest context size (tier)
that holds it. The longest waiting document opens a window of its tier; gaps are filled with the largest waiting
documents that fit, which come from shorter tiers, and the last gap with a piece cut from the shortest. The very last window
of a task is cut into sequences whose lengths are powers of two. All sequences therefore have a length that needs no padding.
Sequences of one context are dealt to step groups of equal token counts over all tasks.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from cyclelake.llm.common import release_memory, staged, text_or_empty

TIERS = (512, 1024, 2048, 4096)
STEP_TOKENS = 32_768     # tokens of a step group
WAITING = 1_000          # documents that wait for a window in a task
KNOWN = 400_000          # chunks a worker remembers
KNOWN_WORDS = 50_000     # and words: they are asked for only by new chunks, mostly of the same slice
SLICE_BYTES = 1_000_000  # text handled at once
# Fixed value: how the vocabulary file cuts words, for lower-case Latin letters and printable ASCII. Blanks come out as well.
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ ]+| ")
ODD = re.compile(r"[^ -~ß-öø-ÿ]|<\|")    # control characters and special strings go to the library
ACCENTED = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]


class Sequences:
    """Ids of many keys in three arrays: Python objects for each id would take most of a worker's memory."""

    def __init__(self):
        self.number: dict = {}
        self.starts, self.sizes, self.ids = (np.zeros(0, np.int32) for _ in range(3))

    def add(self, keys: list, sizes: np.ndarray, ids: np.ndarray) -> None:
        """New keys, and their ids one after the other."""
        self.number.update(zip(keys, range(len(self.number), len(self.number) + len(keys))))
        self.starts = np.concatenate([self.starts, (len(self.ids) + np.cumsum(sizes) - sizes).astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, keys), np.int32, len(keys))

    def of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of keys one after the other, and how many each has."""
        sizes = self.sizes[number].astype(np.int64)
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.starts[number] - (ends - sizes), sizes) + np.arange(sizes.sum())], sizes


class ChunkTokenizer:
    """Ids of texts by the library, remembered per blank-separated chunk.

    For vocabularies that drop white space and never join over it, a text's ids are those of its chunks in order. A new
    chunk of ASCII and lower-case Latin letters needs no normalising: all such chunks of a slice are cut into words at once,
    and the library's model encodes the words that are new; any other chunk goes through the whole library.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        cut = ByteLevel(add_prefix_space=False)
        self.as_bytes = {ord(c): cut.pre_tokenize_str(c)[0][0] for c in ACCENTED}
        self.chunks, self.words = Sequences(), Sequences()

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and blanks (which have none), and how many each has."""
        if len(self.words.number) > KNOWN_WORDS:
            self.words = Sequences()
        new = list(set(words).difference(self.words.number))
        ids: list[int] = []
        ends: list[int] = []
        for word in new:
            if word != " ":
                ids += [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.as_bytes))]
            ends.append(len(ids))
        self.words.add(new, np.diff(np.array(ends, np.int64), prepend=0), np.array(ids, np.int32))
        return self.words.of(self.words.numbers(words))

    def _learn(self, chunks: set[bytes]) -> None:
        new = list(chunks.difference(self.chunks.number))
        if not new:
            return
        if len(self.chunks.number) + len(new) > KNOWN:
            self.chunks = Sequences()
            new = list(chunks)
        joined = b" ".join(new).decode()
        texts = joined.split(" ")
        starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        odd = np.zeros(len(new), bool)
        odd[np.searchsorted(starts, [m.start() for m in ODD.finditer(joined)], "right") - 1] = True
        plain, others = np.flatnonzero(~odd).tolist(), np.flatnonzero(odd).tolist()
        words = WORD.findall(" ".join([texts[k] for k in plain]))
        ids, counts = self._encode_words(words)
        chunk = np.cumsum(np.fromiter(map(" ".__eq__, words), bool, len(words)))
        sizes = np.bincount(chunk, counts, len(plain)).astype(np.int32)
        encoded = [e.ids for e in self.library.encode_batch_fast([texts[k] for k in others], add_special_tokens=False)]
        self.chunks.add([new[k] for k in plain + others], np.concatenate([sizes, np.array([*map(len, encoded)], np.int32)]),
                        np.concatenate([ids, np.fromiter(chain.from_iterable(encoded), np.int32)]))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        at = 0
        while at < len(texts):
            chunks: list[bytes] = []
            counts: list[int] = []
            size = 0
            while at < len(texts) and (not counts or size < SLICE_BYTES):
                raw = texts[at].encode()
                # Lower-case letters have the same ids; special strings are told apart by case.
                if b"<|" in raw:
                    own = [c if b"<|" in c else c.lower() for c in raw.split()]
                else:
                    own = raw.lower().split()
                chunks += own
                counts.append(len(own))
                size += len(raw)
                at += 1
            self._learn(set(chunks))
            ids, sizes = self.chunks.of(self.chunks.numbers(chunks))
            bounds = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
            for a, b in zip(bounds[:-1], bounds[1:]):
                yield ids[a:b]


@dataclass
class Rest:
    """What is left of a document: its ids from ``start`` on."""

    doc_id: object
    ids: np.ndarray
    start: int
    doc_tokens: int


class Packer:
    """Packs documents in the order given; ``rows`` collects one tuple per piece."""

    def __init__(self, task: int, tiers=TIERS, waiting=WAITING):
        self.tiers, self.waiting = tuple(tiers), waiting
        self.next_sequence = task << 40
        self.dealt: dict[int, int] = {}
        self.n = 0
        self.sizes: list[tuple[int, int]] = []   # (length, number) of waiting rests, in order
        self.rests: dict[int, Rest] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        window, total = self.tiers[-1], len(ids)
        full = total // window * window
        for start in range(0, full, window):
            self._emit([Rest(doc_id, ids[start:start + window], start, total)], window)
        if full < total:
            self._wait(Rest(doc_id, ids[full:].copy(), full, total))
        while len(self.rests) > self.waiting:
            self._window()

    def finish(self) -> None:
        while self.rests:
            self._window()

    def _wait(self, rest: Rest) -> None:
        self.n += 1
        self.rests[self.n] = rest
        insort(self.sizes, (len(rest.ids), self.n))

    def _take(self, place: int) -> Rest:
        return self.rests.pop(self.sizes.pop(place)[1])

    def _window(self) -> None:
        """One window of the longest waiting rest's tier."""
        inside = [self._take(-1)]
        tier = next(t for t in self.tiers if t >= len(inside[0].ids))
        gap = tier - len(inside[0].ids)
        while gap and self.sizes:
            place = bisect_right(self.sizes, (gap, self.n + 1)) - 1
            rest = self._take(max(place, 0))
            if place < 0:   # nothing fits whole: cut the shortest
                self._wait(Rest(rest.doc_id, rest.ids[gap:], rest.start + gap, rest.doc_tokens))
                rest = Rest(rest.doc_id, rest.ids[:gap], rest.start, rest.doc_tokens)
            inside.append(rest)
            gap -= len(rest.ids)
        if gap == 0:
            self._emit(inside, tier)
        else:
            self._tail(inside, tier - gap)

    def _tail(self, inside: list[Rest], length: int) -> None:
        """The last window, shorter than its tier: sequences whose lengths are powers of two."""
        while length:
            size, part = 1 << (length.bit_length() - 1), []
            length -= size
            while size:
                rest = inside[0]
                cut = min(size, len(rest.ids))
                part.append(Rest(rest.doc_id, rest.ids[:cut], rest.start, rest.doc_tokens))
                inside[0] = Rest(rest.doc_id, rest.ids[cut:], rest.start + cut, rest.doc_tokens)
                if cut == len(rest.ids):
                    inside.pop(0)
                size -= cut
            self._emit(part, sum(len(p.ids) for p in part))

    def _emit(self, pieces: list[Rest], context: int) -> None:
        dealt = self.dealt.get(context, 0)
        offset = 0
        for piece in pieces:
            crc = zlib.crc32(piece.ids.astype("<u4").tobytes())
            self.rows.append((piece.doc_id, piece.start, len(piece.ids), crc, piece.doc_tokens, self.next_sequence,
                              offset, context, dealt))
            offset += len(piece.ids)
        self.dealt[context] = dealt + 1
        self.next_sequence += 1


def with_step_groups(pieces: DataFrame, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """``pieces`` with step_group: sequences of one context, numbered over all tasks, are dealt to groups of ``step_tokens`` tokens, so
    that in the whole run one group per context is short. The sequences that a task cuts its last window into have contexts of
    their own (the powers of two below the tiers) and form groups like others. A context longer than ``step_tokens`` has one
    sequence per group."""
    task = F.shiftright("sequence_id", 40)
    counts = pieces.groupBy(task.alias("_task"), "context").agg((F.max("dealt") + 1).alias("_n"))
    # One row per task and context.
    before = W.partitionBy("context").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_task", "context", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.floor((F.col("_before") + F.col("dealt")) / F.greatest(F.lit(1), F.floor(F.lit(step_tokens) / F.col("context"))))
    joined = pieces.withColumn("_task", task).join(starts, ["_task", "context"])
    group = F.concat_ws("-", "context", number.cast("string"))
    return joined.withColumn("step_group", group).select(*[c for c in pieces.columns if c != "dealt"], "step_group")


def pack(df: DataFrame, vocabulary: str, end_id=2, id_column="doc_id", text="text") -> DataFrame:
    """One row per piece of a document: id, start, length, ids_crc32 (of the ids as little-endian 32-bit numbers),
    doc_tokens (with the end id), sequence_id, offset, context (the sequence's length) and step_group.

    A document is its ids by the library without added special tokens, then ``end_id``. Null and empty texts are the
    end id alone; null ids and repeated rows are packed like others; other columns are not read. An empty table gives
    no rows. Texts are encoded whole, however long; a long one is cut into windows. The pieces are written once, so
    sequence numbers stay the same when tasks are repeated, and then dealt to step groups.
    """
    id_type = df.schema[id_column].dataType.simpleString()
    schema = (f"`{id_column}` {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint, context bigint, dealt bigint")
    names = [part.split()[0].strip("`") for part in schema.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(names, zip(*rows))), dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer, packer = None, Packer(TaskContext.get().partitionId())
        end = np.array([end_id], np.int32)
        for batch in batches:
            tokenizer = tokenizer or ChunkTokenizer(vocabulary)
            known = batch["_id"].notna()
            for doc_id, has, ids in zip(batch["_id"], known, tokenizer.encode(batch["_text"].tolist())):
                packer.add(doc_id if has else None, np.concatenate([ids, end]))
                if len(packer.rows) > 4_000:
                    yield frame(packer.rows)
                    packer.rows = []
        packer.finish()
        if packer.rows:
            yield frame(packer.rows)
        # Spark deals the tasks of a stage in turn to all workers that earlier stages left: none may keep its tables.
        del tokenizer, packer
        release_memory()

    texts = df.select(F.col(id_column).alias("_id"), text_or_empty(text).alias("_text"))
    return with_step_groups(staged(texts.mapInPandas(run, schema), "pieces"))
