"""The capture source: topic filters, byte ranges, growing files, restarts."""

import pytest

from cyclelake.sources.capture_source import CaptureReader, CaptureSource, topic_pattern
from cyclelake.streaming import jobs as j


@pytest.mark.parametrize("filters, topic, matches", [
    ("#", "a/b", True), ("factory/#", "factory", True), ("factory/#", "factory/a/b", True), ("factory/#", "factories/a", False),
    ("a/+/c", "a/b/c", True), ("a/+/c", "a/b/d/c", False), ("a/+", "a", False), ("a/+/#", "a/b", True), ("+/b", "a/b", True),
    ("a.c/b", "abc/b", False), ("x, a/b", "a/b", True), ("x, a/b", "a/b/c", False),
])
def test_topic_filters(filters, topic, matches):
    assert bool(topic_pattern(filters).fullmatch(topic)) == matches


def test_a_hash_in_the_middle_is_refused():
    with pytest.raises(ValueError):
        topic_pattern("a/#/b")


@pytest.mark.parametrize("size", [1, 2, 7, 30, 10_000])
def test_ranges_give_every_line_once(folder, size):
    lines = ["t a", "no-payload", "", "u " + "x" * 40, "t é ü", "t  two"]
    with open(f"{folder}/0", "w") as file:
        file.write("\n".join(lines) + "\nt last")
    reader = CaptureReader({"path": folder, "rangebytes": size})
    (name, length), = reader.files()
    rows = [row[:2] for part in reader.ranges(name, 0, length) for row in reader.read(part)]
    assert rows == [("t", "a"), ("u", "x" * 40), ("t", "é ü"), ("t", " two"), ("t", "last")]


def test_stream_follows_growing_files_and_restarts(spark, folder):
    spark.dataSource.register(CaptureSource)
    seen = []

    def take():
        stream = spark.readStream.format("capture").option("topics", "f/+/m").option("rangeBytes", 50).load(f"file://{folder}/in")
        j.start(j.append_sink(stream, f"{folder}/out"), f"{folder}/progress").awaitTermination()
        seen.append(sorted(r.raw_payload for r in spark.read.parquet(f"{folder}/out").collect()))

    import os
    os.mkdir(f"{folder}/in")

    def write(name, text):
        with open(f"{folder}/in/{name}", "a") as file:
            file.write(text)

    write("a.log", "".join(f"f/{i % 3}/{'mv'[i % 2]} {i}\n" for i in range(40)) + "f/0/m half")
    take()
    assert seen[-1] == sorted(str(i) for i in range(0, 40, 2))
    take()
    assert seen[-1] == seen[-2]
    write("a.log", " line\nf/0/m 41\n")
    write("b.log", "f/0/m 42\nf/0/x 43\n")
    take()
    assert seen[-1] == sorted([*seen[0], "half line", "41", "42"])
    write("c.log", "f/9/m 44\n")
    take()
    assert seen[-1] == sorted([*seen[0], "half line", "41", "42", "44"])
    batch = spark.read.format("capture").option("topics", "f/0/#").load(f"file://{folder}/in")
    assert batch.filter("topic like 'f/0/%'").count() == batch.count() == 18
