"""Versioned tables: one step from version to version, pinned readers, repeats, compaction, clean-up."""

import threading

import pytest
from pyspark.sql import functions as F

from cyclelake.sources import tables as t, versions as v

SCHEMA = "k string, n bigint"


def rows(spark, *found):
    return spark.createDataFrame(list(found), SCHEMA)


def shown(df):
    return sorted((r.k, r.n) for r in df.select("k", "n").collect())


def newest(df):
    return df.groupBy("k").agg(F.max_by("n", "_new").alias("n"))


def test_reader_during_a_publish_sees_one_version(spark, folder, monkeypatch):
    table, first = f"{folder}/t", [(f"k{i}", 1) for i in range(40)]
    t.upsert_latest(rows(spark, *first), table, ["k"], None, 8)
    seen, publish = [], v.publish

    def watched(spark, table, manifest):
        # Everything of the new version is written by now, nothing of it is to be seen.
        seen.append(shown(t.read_upserted(spark, table)))
        return publish(spark, table, manifest)

    monkeypatch.setattr(v, "publish", watched)
    pinned = t.read_upserted(spark, table)
    t.upsert_latest(rows(spark, *[(k, 2) for k, _ in first], ("new", 2)), table, ["k"], None, 8)
    assert seen == [sorted(first)]
    assert shown(t.read_upserted(spark, table)) == sorted([(k, 2) for k, _ in first] + [("new", 2)])
    assert shown(pinned) == sorted(first)
    assert shown(v.read_snapshot(spark, table, v.snapshot(spark, table, 1))) == sorted(first)


@pytest.mark.parametrize("dies_in", ["write_parts", "publish"])
def test_killed_publish_leaves_the_old_version(spark, folder, monkeypatch, dies_in):
    table = f"{folder}/t"
    t.upsert_latest(rows(spark, ("a", 1), ("b", 1)), table, ["k"], None, 4)

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(v, dies_in, dies)
        with pytest.raises(KeyboardInterrupt):
            t.upsert_latest(rows(spark, ("a", 2)), table, ["k"], None, 4)
    assert shown(t.read_upserted(spark, table)) == [("a", 1), ("b", 1)]
    t.upsert_latest(rows(spark, ("a", 3)), table, ["k"], None, 4)
    assert shown(t.read_upserted(spark, table)) == [("a", 3), ("b", 1)]


def test_a_version_is_taken_once(spark, folder):
    table = f"{folder}/t"
    v.append(rows(spark, ("a", 1)), table, ["k"], 4)
    taken = v.snapshot(spark, table)
    with pytest.raises(v.VersionTaken):
        v.publish(spark, table, taken)
    assert v.versions(spark, table) == [1]


def test_writers_at_the_same_time_lose_nothing(spark, folder):
    table, failed = f"{folder}/t", []

    def write(i):
        try:
            if i % 2:
                v.append(rows(spark, (f"a{i}", i)), table, ["k"], 4, attempts=20)
            else:
                v.merge(rows(spark, (f"a{i}", i)), table, ["k"], newest, 4, attempts=20)
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failed
    assert shown(t.read_upserted(spark, table)) == sorted((f"a{i}", i) for i in range(6))


def test_batches_count_once_and_a_new_stream_starts_over(spark, folder):
    table = f"{folder}/t"
    for batch in (0, 1, 1, 0):
        v.append(rows(spark, ("a", 1), ("b", batch)), table, ["k"], 4, ("stream", batch), own=True)
    assert shown(t.read_upserted(spark, table)) == [("a", 1), ("a", 1), ("b", 0), ("b", 1)]
    v.append(rows(spark, ("c", 5)), table, ["k"], 4, ("another", 0), own=True)
    assert shown(t.read_upserted(spark, table)) == [("c", 5)]


def test_compaction_and_expiry(spark, folder):
    table, total = f"{folder}/t", lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    for i in range(4):
        v.append(rows(spark, ("a", 1), ("b", i)), table, ["k"], 2)
    v.append(rows(spark, ("c", 9)), table, ["k"], 2)
    pinned = v.snapshot(spark, table)
    assert shown(total(v.read_snapshot(spark, table, pinned))) == [("a", 4), ("b", 6), ("c", 9)]
    v.compact(spark, table, total, most=3)
    now = v.snapshot(spark, table)
    assert max(len(parts) for parts in now["buckets"].values()) == 1 and now["version"] == pinned["version"] + 1
    assert shown(t.read_upserted(spark, table)) == [("a", 4), ("b", 6), ("c", 9)]
    assert v.compact(spark, table, total, most=3)["version"] == now["version"]
    # Young folders stay for readers that hold an old manifest.
    assert v.expire(spark, table, keep=1) == 0 and shown(total(v.read_snapshot(spark, table, pinned))) == [("a", 4), ("b", 6), ("c", 9)]
    v.write_parts(rows(spark, ("lost", 1)), table, ["k"], 2)
    assert v.expire(spark, table, keep=1, minutes=0) >= 5
    assert v.versions(spark, table) == [now["version"]] and shown(t.read_upserted(spark, table)) == [("a", 4), ("b", 6), ("c", 9)]


def test_empty_rows_new_columns_and_dropped_keys(spark, folder):
    table = f"{folder}/t"
    assert v.snapshot(spark, table) is None
    t.upsert_latest(rows(spark), table, ["k"], None, 4)
    assert shown(t.read_upserted(spark, table)) == []
    t.upsert_latest(rows(spark, ("a", 1), ("b", 2)), table, ["k"], None, 4)
    t.upsert_latest(rows(spark, ("b", 3)).withColumn("x", F.lit("more")), table, ["k"], None, 4)
    found = {r.k: (r.n, r.x) for r in t.read_upserted(spark, table).collect()}
    assert found == {"a": (1, None), "b": (3, "more")}
    with pytest.raises(ValueError):
        v.append(rows(spark, ("a", 1)), table, ["n"], 4)
    waiting = f"{folder}/w"
    one = lambda *names: spark.createDataFrame([(n,) for n in names], "k string")
    for drop, keep in ((one("a", "b", "c"), one("a", "c")), (one("a", "d"), one("d"))):
        t.replace_keys(drop, keep, waiting, ["k"], 2)
    assert sorted(r.k for r in t.read_upserted(spark, waiting).collect()) == ["c", "d"]


def test_new_rows_of_a_merge_are_shuffled_by_bucket_once(spark, folder, monkeypatch):
    table, calls, write_parts = f"{folder}/t", [], v.write_parts
    monkeypatch.setattr(v, "write_parts", lambda *args: calls.append(1) or write_parts(*args))
    t.upsert_latest(rows(spark, *[(f"k{i}", 1) for i in range(20)]), table, ["k"], "n", 4)
    t.upsert_latest(rows(spark, ("k1", 2), ("k1", 2), ("k2", 0), (None, 3), (None, 3)), table, ["k"], "n", 4)
    assert len(calls) == 2
    found = t.read_upserted(spark, table).collect()
    expected = {f"k{i}": 1 for i in range(20)} | {"k1": 2, None: 3}
    assert {r.k: r.n for r in found} == expected and len(found) == 21
    # What was put beside the table for the merge is gone, and an empty merge changes no row.
    named = {f.rsplit("/", 1)[0] for n in v.versions(spark, table) for parts in v.snapshot(spark, table, n)["buckets"].values() for f in parts}
    assert {f"data/{s.getPath().getName()}" for s in v._listed(spark, f"{table}/data")} == named
    t.upsert_latest(rows(spark), table, ["k"], "n", 4)
    assert t.read_upserted(spark, table).count() == 21
