import hashlib
import random

import numpy as np
import pytest

from cyclelake.llm import suffix_dedup
from cyclelake.llm.deep_shallow import sort_suffixes
from cyclelake.llm.suffix_dedup import remove_repeats, repeats_report, runs_of_anchors


def plain(rows, limit=50):
    """Every string of the length, by definition."""
    least = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - limit + 1):
            if doc_id is not None:
                s = raw[i:i + limit]
                least[s] = min(least.get(s, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - limit + 1):
            if doc_id is not None and least[raw[i:i + limit]] < doc_id:
                gone[i:i + limit] = b"\1" * limit
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id is not None, doc_id or 0, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shown(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def some_rows(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeü ") for _ in range(rng.randint(2, 9))) for _ in range(60)]
    line = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [line(25) for _ in range(4)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.35 and texts:
            parts = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, 3)):
                parts[rng.randrange(len(parts))] = rng.choice(words)
            texts.append(" ".join(parts))
        elif kind < 0.6:
            texts.append(line(rng.randint(0, 20)) + rng.choice(passages)[rng.randint(0, 30):] + line(rng.randint(0, 20)))
        else:
            texts.append(line(rng.randint(0, 60)))
    texts += ["a" * 300, "b" + "a" * 170, "ab" * 90, passages[0][:49], passages[0][:50], passages[0][1:51], "", None]
    rows = list(zip(rng.sample(range(1000), len(texts)), texts))
    rng.shuffle(rows)
    return rows + [rows[0], (rows[1][0], rows[2][1]), (None, passages[0]), (None, None)]


@pytest.mark.parametrize("seed, hot, piece", [(1, 1000, 64), (2, 1000, 3), (3, 3, 64), (4, 1, 5)])
def test_equals_definition(spark, documents, monkeypatch, seed, hot, piece):
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 2500)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    rows = some_rows(seed, 70)
    df = documents(rows).repartition(4)
    # Tasks run in processes of their own, so the settings travel inside the functions.
    answers, stretches = suffix_dedup._answers, suffix_dedup._stretches
    def small_answers(group):
        suffix_dedup.HOT = hot
        return answers(group)
    def small_stretches(buckets, limit):
        run = stretches(buckets, limit)
        def small(key, slices, found):
            suffix_dedup.STRETCH, suffix_dedup.BLOCK = piece, 700
            return run(key, slices, found)
        return small
    monkeypatch.setattr(suffix_dedup, "_answers", small_answers)
    monkeypatch.setattr(suffix_dedup, "_stretches", small_stretches)
    assert shown(repeats_report(df)) == plain(rows)


def test_empty_long_and_other_columns(spark, documents):
    assert repeats_report(documents([])).collect() == []
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(2_300_000))
    rows = [(5, long), (2, long[1_000_000:1_000_200]), (9, "x" + long[2_100_000:2_100_060] + "y")]
    df = documents([(i, t) for i, t in rows]).withColumnRenamed("lang", "slice").withColumnRenamed("source", "starts")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats_report(df).collect()}
    assert got == {5: (200, 1), 2: (0, 0), 9: (60, 1)}
    spans = {r.doc_id: (r.starts, r.ends, bytes(r.kept)) for r in remove_repeats(df).collect()}
    assert spans[5][:2] == ([1_000_000], [1_000_200]) and spans[9] == ([1], [61], b"xy")


def test_blocks_give_the_same_windows(monkeypatch):
    rng = np.random.default_rng(3)
    text, ends = rng.integers(97, 100, 5000).astype(np.uint8), np.array([20, 70, 1500, 1549, 5000])
    def windows():
        a, d, s, n = runs_of_anchors(text, ends, 50)
        return [(int(a[i]), int(d[i]), int(s[i]) + k) for i in range(len(a)) for k in range(n[i])]
    whole = windows()
    assert [(d, s) for _, d, s in whole] == [(d, s) for d, (x, y) in enumerate(zip([0, *ends], ends)) for s in range(x, y - 49)]
    monkeypatch.setattr(suffix_dedup, "BLOCK", 333)
    assert windows() == whole


@pytest.mark.parametrize("seed", range(40))
def test_sorts_suffixes(seed):
    rng = random.Random(seed)
    limit = rng.choice([8, 13, 20, 50])
    shallow = rng.choice([s for s in (8, 16, 32, 48) if s <= limit])
    raw = bytes(rng.randrange(rng.choice([1, 2, 4, 256])) for _ in range(rng.choice([60, 300])))
    raw = raw + raw[:40] + b"\7" + raw[3:]
    suffixes = np.array(rng.sample(range(len(raw) - limit + 1), rng.choice([0, 1, 50])), np.int64)
    group = np.array([rng.randrange(3) for _ in suffixes], np.int64)
    order, new = sort_suffixes(np.frombuffer(raw, np.uint8), suffixes, group, limit, shallow)
    of = dict(zip(suffixes.tolist(), group.tolist()))
    want = sorted((of[s], raw[s:s + limit]) for s in suffixes.tolist())
    assert [(of[s], raw[s:s + limit]) for s in order.tolist()] == want
    assert new.tolist() == [i == 0 or want[i] != want[i - 1] for i in range(len(want))]
