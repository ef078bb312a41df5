"""Token counts by rank-synchronous array merging.

The pre-tokens of a slice of text are held as one ragged numpy array of symbol ids; in each round every sequence merges
all places of its own lowest-ranked pair at the same time, until no sequence holds a known pair. The symbols left are
counted. A single space between two words always starts a pre-token, so texts are cut there first and the counts of the
chunks, most of which repeat, are kept in a bounded table per Python worker.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelake.llm.common import text_or_empty

# Fixed value: the pre-token pattern of byte-level vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
KNOWN = 400_000          # chunks a worker remembers
SLICE_CHARS = 500_000    # text handled at once
SLICE_TOKENS = 150_000   # pre-tokens of one long text handled at once
SLOTS = 20               # bits of the pair table's slots
NO_PAIR = np.int64(1 << 40)
UNEVEN = -(1 << 60)      # marks a chunk that touches white space: its text is counted as a whole


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: printable Latin-1 bytes stand for
    themselves, the others follow in order from code point 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Merger:
    """Counts tokens with the vocabulary file of a byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)   # by rank
        self._index(keys)
        self.byte_ids = np.array([ids[s] for s in _byte_symbols()], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.pattern = regex.compile(PRE_TOKEN)
        self.known: dict[str, int] = {}

    def _index(self, keys: np.ndarray) -> None:
        """An open-addressed table from pair key to rank, filled round by round."""
        self.table = np.full(1 << SLOTS, len(keys), np.int64)
        self.keys = np.append(keys, -1)
        waiting, self.probes = np.arange(len(keys)), 0
        while len(waiting):
            slot = self._slot(keys[waiting], self.probes)
            free = self.table[slot] == len(keys)
            first = np.zeros(len(waiting), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            self.table[slot[free & first]] = waiting[free & first]
            waiting = waiting[~(free & first)]
            self.probes += 1

    @staticmethod
    def _slot(keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = (keys.astype(np.uint64) + np.uint64(probe)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - SLOTS)).astype(np.int64)

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each pair; NO_PAIR where the vocabulary has none."""
        out = np.full(len(keys), NO_PAIR)
        left = np.arange(len(keys))
        for probe in range(self.probes):
            found = self.table[self._slot(keys[left], probe)]
            right = self.keys[found] == keys[left]
            out[left[right]] = found[right]
            left = left[~right & (found < len(self.merged))]
            if len(left) == 0:
                break
        return out

    def symbols_left(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols of each byte string (none empty) after all merges."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        left = lengths.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), lengths)
        while len(symbols) > 1:
            rank = np.append(self.ranks(symbols[:-1] << 32 | symbols[1:]), NO_PAIR)
            last = np.append(owner[1:] != owner[:-1], True)
            rank[last] = NO_PAIR
            starts = np.append(0, np.flatnonzero(last)[:-1] + 1)
            sizes = np.diff(np.append(starts, len(symbols)))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            hit = np.flatnonzero((rank == lowest) & (rank < NO_PAIR))
            if len(hit) == 0:
                break
            # Runs of neighbouring hits (a pair of equal symbols) merge every second place, from the left.
            run_start = np.append(True, np.diff(hit) != 1)
            within = np.arange(len(hit)) - np.maximum.accumulate(np.where(run_start, np.arange(len(hit)), 0))
            hit = hit[within % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            keep = lowest < NO_PAIR   # finished sequences leave the arrays
            keep[hit + 1] = False
            left -= np.bincount(owner[hit], minlength=len(left))
            symbols, owner = symbols[keep], owner[keep]
        return left

    def learn(self, chunks: set[str]) -> None:
        """Counts of new chunks. A chunk stands for itself with a space before it; one that starts with a space is the
        head of a text and stands for the rest."""
        new = list(chunks.difference(self.known))
        if not new:
            return
        if len(self.known) + len(new) > KNOWN:
            self.known.clear()
            new = list(chunks)
        heads = [c for c in new if c[:1] == " "]
        even = [c for c in new if c and not c[0].isspace() and not c[-1].isspace()]
        self.known.update(dict.fromkeys(new, UNEVEN))
        # Cut all at once: in the joined text only the first token of a chunk starts with a space.
        tokens = self.pattern.findall("".join([" " + c for c in even]))
        owner = np.cumsum(np.fromiter((t[0] == " " for t in tokens), np.int64, len(tokens))) - 1
        for chunk in heads:
            if len(chunk) == 1 or not (chunk[1].isspace() or chunk[-1].isspace()):
                even.append(chunk)
                cut = self.pattern.findall(chunk[1:])
                tokens += cut
                owner = np.append(owner, np.full(len(cut), len(even) - 1))
        left = self.symbols_left([t.encode() for t in tokens]) if tokens else None
        counts = np.bincount(owner, weights=left, minlength=len(even)).astype(np.int64).tolist()
        self.known.update(zip(even, counts))

    def _whole(self, text: str) -> int:
        """Tokens of a text cut by the pattern alone, a bounded number of pre-tokens at a time."""
        found, total = self.pattern.finditer(text), 0
        while tokens := [m.group() for m in islice(found, SLICE_TOKENS)]:
            total += int(self.symbols_left([t.encode() for t in tokens]).sum())
        return total

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text. A special string inside a text is one token."""
        out, at = [0] * len(texts), 0
        while at < len(texts):
            taken, chars = [], 0
            while at < len(texts) and (not taken or chars + len(texts[at]) <= SLICE_CHARS):
                parts = [texts[at]]
                if any(s in texts[at] for s in self.special):
                    parts = self.cut.split(texts[at])
                    out[at] = len(parts) - 1
                for part in parts:
                    if len(part) > SLICE_CHARS:
                        out[at] += self._whole(part)
                    elif part:
                        chunks = part.split(" ")
                        chunks[0] = " " + chunks[0]
                        taken.append((at, part, chunks))
                chars += len(texts[at])
                at += 1
            self.learn(set().union(*[chunks for _, _, chunks in taken]))
            for row, part, chunks in taken:
                count = sum(map(self.known.__getitem__, chunks))
                out[row] += count if count >= 0 else self._whole(part)
        return out


_MERGERS: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    """One per worker and file; Python workers serve many tasks."""
    if path not in _MERGERS:
        _MERGERS[path] = Merger(path)
    return _MERGERS[path]


def count_tokens(df: DataFrame, vocabulary: str, id_column="doc_id", text="text", limit=1024) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit): one row per input row, as many as there are.

    ``vocabulary``: path of a byte-level BPE file that every executor can read. Null texts count as empty (0 bytes, 0
    tokens); null ids and repeated rows are kept; other columns are not read. A map-only job: nothing is shuffled.
    """

    @F.pandas_udf("bigint")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = merger(vocabulary)
        for texts in batches:
            yield pd.Series(counter.counts(texts.tolist()), dtype="int64")

    known = df.select(F.col(id_column), text_or_empty(text).alias("_text"))
    counted = known.select(id_column, F.octet_length("_text").cast("bigint").alias("n_bytes"),
                           tokens("_text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
