import random

import pytest
from pyspark.sql import functions as F

from conftest import at, event, events, materials, order, orders, reading, readings
from cyclelake.functions.ordered import OrderedSeries, as_of_value, first_n_per_key, last_n_per_key
from cyclelake.operators import state as st


def test_ring_buffer_keeps_newest(spark):
    df = readings(spark, [reading(i, value=i, seconds=i) for i in range(6)])
    assert sorted(r.value for r in st.retain_last_n(df, 3).collect()) == [3, 4, 5]


def test_channels_and_ovens_are_independent(spark):
    rows = [reading(1, value=1), reading(2, "moisture", 2), reading(3, value=3, oven="oven-02")]
    found = {(r.oven_id, r.sensor_type): r.value for r in st.latest_per_channel(readings(spark, rows)).collect()}
    assert found == {("oven-01", "temperature"): 1, ("oven-01", "moisture"): 2, ("oven-02", "temperature"): 3}
    assert {r.oven_id for r in st.known_ovens(readings(spark, rows)).collect()} == {"oven-01", "oven-02"}


def test_active_order_is_set_and_cleared(spark):
    rows = [reading(1, seconds=0)]
    assert st.active_order(readings(spark, rows)).first().order_id == "ORD-2031-07315"
    rows.append(reading(2, seconds=5, order=None))
    assert st.active_order(readings(spark, rows)).first().order_id is None


def test_historian_query(spark):
    rows = [reading(i, value=10 * i, seconds=5 * i) for i in range(10)]
    rows += [reading(100 + i, "moisture", 2000 - 100 * i, seconds=5 * i) for i in range(5)]
    df = readings(spark, rows)
    query = lambda **k: st.historian_query(df, k.pop("order_id", "ORD-2031-07315"), "oven-01", **k).collect()
    assert len(query()) == 15
    assert len(query(sensor_type="moisture")) == 5
    assert len(query(sensor_type="temperature", from_ts=at(seconds=25))) == 5
    assert len(query(to_ts=at(seconds=0))) == 2
    assert [r.timestamp_opc for r in query(limit=3)] == [at(seconds=0), at(seconds=0), at(seconds=5)]
    assert query(order_id="ORD-2026-99999") == []
    times = [r.timestamp_opc for r in query()]
    assert times == sorted(times)
    for limit in (0, 10001):
        with pytest.raises(ValueError):
            query(limit=limit)


def test_historian_response(spark):
    rows = [reading(3 * i + j, s, i, minutes=i / 2) for i in range(5) for j, s in enumerate(st.SENSOR_TYPES)]
    answer = st.historian_response(readings(spark, rows)).first()
    assert answer["count"] == 15 and len(answer.readings) == 15
    assert sum(r.sensor_type == "moisture" for r in answer.readings) == 5
    assert [r.timestamp_opc for r in answer.readings] == sorted(r.timestamp_opc for r in answer.readings)
    for limit in (4, 2000):
        assert st.historian_response(readings(spark, rows), limit).first()["count"] == min(limit, 15)


@pytest.mark.parametrize("moisture, minutes, status, met", [
    (2000, 100, "running", False), (250, 100, "cycle_complete", True), (500, 100, "running", False),
    (None, 100, "running", None), (250, 600, "timeout", True), (250, 599.99, "cycle_complete", True),
])
def test_status_cases(spark, moisture, minutes, status, met):
    rows = [reading(1, value=80)]
    if moisture is not None:
        rows.append(reading(2, "moisture", moisture, seconds=5))
    row = st.process_state(readings(spark, rows), 500, 600, at(minutes)).first()
    assert (row.status, row.moisture_threshold_met) == (status, met)


def test_idle_and_unknown_ovens(spark):
    df = readings(spark, [reading(1, order=None)])
    ovens = spark.createDataFrame([("oven-01",), ("oven-77",)], "oven_id string")
    rows = {r.oven_id: r for r in st.process_state(df, as_of=at(5), ovens=ovens).collect()}
    assert rows["oven-01"].status == rows["oven-77"].status == "idle"
    assert rows["oven-01"].temperature_degC == 1.0 and rows["oven-77"].temperature_degC is None
    assert rows["oven-01"].cycle_elapsed_minutes is None


def test_change_of_order_keeps_the_start(spark):
    rows = [reading(1, order="A"), reading(2, order="B", minutes=10), reading(3, order=None, minutes=20),
            reading(4, order="C", minutes=30), reading(5, order="D", minutes=40)]
    df = readings(spark, rows)
    edges = [(r.edge, r.reading_id) for r in st.cycle_edges(df).orderBy("timestamp_opc").collect()]
    assert edges == [("start", "r000001"), ("end", "r000003"), ("start", "r000004")]
    assert st.cycle_elapsed_minutes(df, at(45)).first().cycle_elapsed_minutes == 15
    assert st.cycle_elapsed_minutes(df, at(45), restart_on_change=True).first().cycle_elapsed_minutes == 5
    runs = st.cycle_runs(df).orderBy("run_number").collect()
    assert [(r.run_number, r.n_orders, r.n_readings) for r in runs] == [(1, 2, 2), (2, 2, 2)]
    assert st.cycle_runs(df, restart_on_change=True).count() == 4


def test_good_only_ignores_bad_readings(spark):
    df = readings(spark, [reading(1, "moisture", 900), reading(2, "moisture", 100, minutes=1, quality="Bad")])
    assert st.process_state(df, as_of=at(5)).first().status == "cycle_complete"
    assert st.process_state(df, as_of=at(5), good_only=True).first().status == "running"


def test_material_limits(spark):
    df = readings(spark, [reading(1, "moisture", 450, order="ORD-2031-07290")])
    known = orders(spark, [order("ORD-2031-07290", "MAT-0002")])
    row = st.process_state_per_material(df, known, materials(spark), as_of=at(299)).first()
    assert row.status == "cycle_complete"
    row = st.process_state_per_material(df, known, materials(spark), as_of=at(300)).first()
    assert row.status == "timeout"


def test_sensor_fault_needs_thirty_seconds(spark):
    rows = [reading(i, quality="Bad", seconds=5 * i) for i in range(7)]
    assert st.sensor_fault(readings(spark, rows)).count() == 0
    rows.append(reading(7, quality="Bad", seconds=31))
    assert st.sensor_fault(readings(spark, rows)).first().n_bad == 8
    rows.append(reading(8, seconds=12.5))
    assert st.sensor_fault(readings(spark, rows)).count() == 0


def test_asof_stamp(spark):
    log = [event(1, "cycle_started", "A", 10), event(2, "cycle_confirmed", "A", 20), event(3, "cycle_started", "B", 300)]
    rows = [reading(i, minutes=m, order="x") for i, m in enumerate([5, 10, 15, 20, 299, 300, 4000])]
    stamped = st.asof_order_stamp(readings(spark, rows), events(spark, log)).orderBy("reading_id").collect()
    assert [r.order_id for r in stamped] == [None, "A", "A", None, None, "B", "B"]


@pytest.mark.parametrize("key_rows", [1_000_000, 5])    # keys left whole, keys cut into slices
def test_asof_reads_its_input_once(spark, key_rows):
    counted = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(oven):
        counted.add(1)
        return oven

    left = readings(spark, [reading(i, minutes=i) for i in range(40)]).withColumn("oven_id", seen.asNondeterministic()("oven_id"))
    marks = events(spark, [event(1, "cycle_started", "A", 10)])
    stamped = as_of_value(left.drop("order_id"), marks, ["oven_id"], ("timestamp_opc", "reading_id"), ("event_time", "event_id"),
                          F.col("order_id"), "order_id", key_rows=key_rows)
    assert [r.order_id for r in stamped.orderBy("timestamp_opc").collect()] == [None] * 10 + ["A"] * 30
    assert counted.value == 40


def test_cycle_phases(spark):
    from cyclelake.operators.silver import cycle_pairs

    rows = [reading(i, "moisture", v, m) for i, (m, v) in enumerate(
        [(0, 5000), (30, 200), (60, 5000), (61, 301), (100, 300), (105, 900)])]
    log = cycle_pairs(events(spark, [event(1, "cycle_started")]).withColumn("sap_confirmation_number", F.lit(None)))
    tagged = st.cycle_phase(readings(spark, rows), log, orders(spark, [order()]), materials(spark))
    found = [r.phase for r in tagged.orderBy("reading_id").collect()]
    assert found == ["idle", "warming", "warming", "drying", "complete", "complete"]


def hot_rows(n=3000, seed=7):
    """A third of all rows in one oven and another third of that at one instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        oven = "oven-00" if rng.random() < 0.4 else f"oven-{rng.randrange(1, 30):02d}"
        minutes = 77 if rng.random() < 0.3 else rng.randrange(0, 20000)
        found = None if rng.random() < 0.3 else f"o{rng.randrange(4)}"
        rows.append(reading(i, "moisture", rng.randrange(100), minutes, order=found, oven=oven))
    rng.shuffle(rows)
    return rows


# Plain windows, time slices, and slices balanced by range.
@pytest.mark.parametrize("max_rows, key_rows", [(None, None), (None, 10), (50, 10)])
def test_ordered_series_against_brute_force(spark, max_rows, key_rows):
    rows = hot_rows()
    series = lambda: OrderedSeries(readings(spark, rows), ["oven_id"], ["timestamp_opc", "reading_id"], 60, max_rows, key_rows)
    previous = {r.reading_id: r for r in series().with_previous(p="order_id", q="value").collect()}
    seen = {r.reading_id: r for r in series().with_last_seen(s=F.col("order_id")).collect()}
    low = {r.reading_id: r for r in series().with_extreme("m", F.col("value"), "min", False).collect()}
    high = {r.reading_id: r for r in series().with_extreme("m", F.col("value")).collect()}
    number = {r.reading_id: r for r in series().with_row_number("n").collect()}
    assert len(previous) == len(seen) == len(low) == len(high) == len(number) == len(rows)
    for oven in {r[2] for r in rows}:
        before, last, floor, top = (None, None), None, None, None
        for i, r in enumerate(sorted((r for r in rows if r[2] == oven), key=lambda r: (r[8], r[0])), 1):
            top = r[5] if top is None else max(top, r[5])
            last = last if r[1] is None else r[1]
            assert (previous[r[0]].p, previous[r[0]].q) == before
            assert (seen[r[0]].s, low[r[0]].m, high[r[0]].m, number[r[0]].n) == (last, floor, top, i)
            before, floor = (r[1], r[5]), r[5] if floor is None else min(floor, r[5])


@pytest.mark.parametrize("max_rows, key_rows, inclusive", [(None, None, True), (None, 10, False), (40, 10, True), (40, 10, False)])
def test_as_of_value_against_brute_force(spark, max_rows, key_rows, inclusive):
    rows = hot_rows(1200)
    left, right = rows[:700], rows[700:]
    found = as_of_value(
        readings(spark, left), readings(spark, right), ["oven_id"], ("timestamp_opc", "reading_id"),
        ("timestamp_opc", "reading_id"), F.col("reading_id"), "hit", inclusive, 60, max_rows, key_rows,
    )
    hits = {r.reading_id: r.hit for r in found.collect()}
    for r in left:
        prior = [x for x in right if x[2] == r[2] and (x[8] < r[8] or (inclusive and x[8] == r[8]))]
        assert hits[r[0]] == (max(prior, key=lambda x: (x[8], x[0]))[0] if prior else None)


@pytest.mark.parametrize("n", [20, 1001])
def test_first_and_last_n(spark, n):
    rows = [reading(i, minutes=i % 97, oven="oven-00" if i % 3 else "oven-01") for i in range(3600)]
    df, order_by = readings(spark, rows), ["timestamp_opc", "reading_id"]
    for pick, cut in ((first_n_per_key, slice(None, n)), (last_n_per_key, slice(-n, None))):
        found = {r.reading_id for r in pick(df, ["oven_id"], order_by, n).collect()}
        expected = set()
        for oven in ("oven-00", "oven-01"):
            mine = sorted((r for r in rows if r[2] == oven), key=lambda r: (r[8], r[0]))
            expected |= {r[0] for r in mine[cut]}
        assert found == expected
