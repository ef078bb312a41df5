"""Streams give the batch results over split, repeated and disordered files, and again after a repeated batch."""

import datetime as dt
import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import MATERIALS, at, event, events, materials, order, orders, reading, readings
from cyclelake import schemas
from cyclelake.operators import gold as g, partials as p, silver as s, state as st, timeseries as ts
from cyclelake.sources import messages as m, reference as ref, tables as t, versions as v
from cyclelake.streaming import jobs as j

CONFIRMED = '{"sap_confirmation_number": "CONF-2031-55102", "goods_movement_document": "GR-2031-700412"}'


def land(df, folder, parts, batch, stream=None):
    """Appends the rows in ``parts`` steps and lets the stream take each step as one batch."""
    rows = df.collect()
    for i in range(parts):
        chunk = rows[i * len(rows) // parts:(i + 1) * len(rows) // parts]
        df.sparkSession.createDataFrame(chunk, df.schema).write.mode("append").parquet(f"{folder}/landing")
        source = df.sparkSession.readStream.schema(df.schema).parquet(f"{folder}/landing")
        with j.rocksdb(df.sparkSession):
            j.start(batch(stream(source) if stream else source), f"{folder}/progress").awaitTermination()


def test_bronze_and_quarantine(spark, folder):
    good = {"reading_id": "a", "timestamp_opc": "2031-11-19T04:17:50Z", "timestamp_mqtt": "2031-11-19T04:17:50Z", "plant": "regensburg",
            "oven_id": "oven-01", "sensor_type": "vacuum", "value": 4, "unit": "mbar", "quality": "Bad"}
    texts = [json.dumps({**good, "reading_id": str(i)}) for i in range(20)] + ["x", "[]"]
    df = spark.createDataFrame([("t", x) for x in texts], m.MESSAGE_SCHEMA)
    df.write.json(f"{folder}/landing")
    job = j.bronze_stream(m.read_sensor_stream(spark, f"{folder}/landing", 2), f"{folder}/bronze", f"{folder}/bad")
    j.start(job, f"{folder}/progress").awaitTermination()
    assert t.read_bronze(spark, f"{folder}/bronze").count() == 20
    assert spark.read.parquet(f"{folder}/bad").count() == 2
    kafka = spark.createDataFrame([("t", bytearray(b"{}"))], "topic string, value binary")
    assert m.from_kafka(kafka).first().raw_payload == "{}"


def test_silver_equals_batch(spark, folder):
    rows = [reading(i, value=i, minutes=i % 50, quality="Bad" if i % 7 == 0 else "Good") for i in range(200)]
    rows += rows[50:120]
    random.Random(1).shuffle(rows)
    df = readings(spark, rows)
    land(df, folder, 3, lambda x: j.append_sink(x, f"{folder}/out"), lambda x: j.silver_readings_stream(x, "2 hours"))
    found = {tuple(r) for r in spark.read.schema(df.schema).parquet(f"{folder}/out").collect()}
    assert found == {tuple(r) for r in s.silver_readings(df).collect()}


def gold_job(spark, folder, dimensions, **options):
    """The stream over everything that has landed so far, on its checkpoint."""

    def run(checkpoint="progress", named=()):
        live = [spark.readStream.schema(x).parquet(f"{folder}/{name}")
                for name, x in (("log", schemas.EVENT), ("series", schemas.READING))]
        job = j.gold_stream(*live, dimensions, f"{folder}/state", f"{folder}/gold", f"{folder}/pending", named, buckets=4,
                            most_parts=2, **options)
        with j.rocksdb(spark):
            j.start(job, f"{folder}/{checkpoint}").awaitTermination()

    return run


def cycles(n):
    log, known, rows = [], [], []
    for i in range(n):
        name = f"ORD-2031-{i:05d}"
        known.append(order(name, MATERIALS[i % 4][0]))
        log += [event(2 * i, "cycle_started", name, i), event(2 * i + 1, "cycle_confirmed", name, 300 + i, payload=CONFIRMED)]
        rows += [reading(10 * i + k, "moisture", 1000.1 - 300 * k + i, 60 * k, order=name) for k in range(4)]
        rows += [reading(10 * i + 4 + k, ["temperature", "vacuum"][k % 2], 3.3 * i + k, 30 * k, order=name) for k in range(4)]
    return log, known, rows


def test_gold_equals_batch_in_any_arrival_order(spark, folder):
    """Events, readings, copies and orders in random arrivals; a lost checkpoint; a late order without any new row."""
    log, known, rows = cycles(15)
    rows += [reading(8000, "moisture", 7, 250, order="ORD-2031-00005"), reading(8001, "moisture", 5, 10, quality="Bad", order="ORD-2031-00006")]
    rng, stuff, parts = random.Random(2), materials(spark), {"orders": known[:4]}
    log, series = log + log[4:9], rows + rows[30:50]
    rng.shuffle(log)
    rng.shuffle(series)
    asked = []

    def dimensions(changed):
        asked.append({r.order_id for r in changed.collect()})
        return s.silver_orders(orders(spark, parts["orders"])), stuff, None

    run = gold_job(spark, folder, dimensions)
    columns = schemas.GOLD.fieldNames()
    read = lambda: {tuple(r) for r in t.read_upserted(spark, f"{folder}/gold").select(*columns).collect()}
    for i in range(4):
        events(spark, log[i::4]).write.mode("append").parquet(f"{folder}/log")
        readings(spark, series[i::4]).write.mode("append").parquet(f"{folder}/series")
        run()
    assert len(read()) == 4
    waiting = {r.order_id for r in t.read_upserted(spark, f"{folder}/pending").collect()}
    assert waiting == {o[0] for o in known[4:]}
    # The orders arrive. Nothing else does but a tick, which names no order at all.
    parts["orders"] = known
    spark.createDataFrame([(None,)], "order_id string").write.parquet(f"{folder}/ticks")
    tick = spark.readStream.schema("order_id string").parquet(f"{folder}/ticks")
    run("ticking", [tick])    # another checkpoint: the sources are read again, into empty states
    silver = s.silver_readings(readings(spark, rows))
    expected = {tuple(r) for r in g.gold_cycle_summary(
        s.cycle_pairs(s.silver_cycle_events(events(spark, log))), s.silver_orders(orders(spark, known)), stuff, silver).collect()}
    close = lambda found: {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in found}
    assert close(read()) == close(expected) and len(expected) == 15
    assert t.read_upserted(spark, f"{folder}/pending").count() == 0
    # One late reading: its order is the only one that is looked at, and its older readings count still.
    asked.clear()
    readings(spark, [reading(9000, "moisture", 3, 260, order="ORD-2031-00005")]).write.mode("append").parquet(f"{folder}/series")
    run("ticking", [tick])
    assert asked == [{"ORD-2031-00005"}]
    row = t.read_upserted(spark, f"{folder}/gold").filter("order_id = 'ORD-2031-00005'").first()
    assert row.final_moisture_ppm == 3
    assert row.avg_moisture_ppm == pytest.approx(sum([1005.1, 705.1, 405.1, 105.1, 7, 3]) / 6)


def test_gold_after_a_crash_between_states_and_gold(spark, folder, monkeypatch):
    """The batch runs again: its states are in already and must not count twice."""
    log, known, rows = cycles(3)
    dimensions = lambda changed: (s.silver_orders(orders(spark, known)), materials(spark), None)
    run = gold_job(spark, folder, dimensions)
    events(spark, log).write.parquet(f"{folder}/log")
    readings(spark, rows).write.parquet(f"{folder}/series")

    def dies(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(j, "upsert_latest", dies)
        with pytest.raises(Exception, match="killed"):
            run()
    run()
    found = {r.order_id: r.avg_moisture_ppm for r in t.read_upserted(spark, f"{folder}/gold").collect()}
    assert found == pytest.approx({f"ORD-2031-{i:05d}": 550.1 + i for i in range(3)})
    state = t.read_upserted(spark, f"{folder}/state").groupBy("order_id").sum("moisture_n").collect()
    assert {r[1] for r in state} == {4}


def test_partials_merge_in_any_grouping(spark):
    log, _, rows = cycles(4)
    both = s.parse_event_payload(events(spark, log)).unionByName(readings(spark, rows), allowMissingColumns=True)
    whole = {tuple(r) for r in p.order_partials(both).collect()}
    for seed in (1, 2):
        parts = [p.order_partials(both.filter(F.pmod(F.xxhash64("event_id", "reading_id", F.lit(seed)), F.lit(5)) == k)) for k in range(5)]
        states = parts[0]
        for part in parts[1:]:
            states = states.unionByName(part)
        assert {tuple(r) for r in p.merge_partials(states).collect()} == whole
    odd = readings(spark, [reading(1, "moisture", float("nan")), reading(2, "moisture", 1e300), reading(3, "moisture", 1.5)])
    blank = s.parse_event_payload(events(spark, []))
    stats = p.sensor_stats_of(p.order_partials(blank.unionByName(odd, allowMissingColumns=True))).first()
    assert stats.avg_moisture_ppm != stats.avg_moisture_ppm


def test_process_state_equals_batch(spark, folder):
    rng = random.Random(4)
    rows = [reading(i, rng.choice(schemas.SENSOR_TYPES), rng.randrange(1000), i, order=None if (i // 40) % 3 == 0 else f"o{i // 40}",
                    oven=rng.choice(["oven-01", "oven-01", "oven-02", "oven-03"])) for i in range(400)]
    df = readings(spark, rows)
    land(df, folder, 5, lambda x: j.process_state_stream(x, f"{folder}/state", 4))
    found = j.read_process_state(spark, f"{folder}/state", 500, 600, at(420))
    expected = st.process_state(df, 500, 600, at(420))
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in expected.collect()}
    # Repeating the last batch changes nothing.
    last = spark.createDataFrame(rows[320:], schemas.READING)
    last.write.parquet(f"{folder}/repeat")
    j.start(j.process_state_stream(spark.readStream.schema(df.schema).parquet(f"{folder}/repeat"), f"{folder}/state", 4),
            f"{folder}/again").awaitTermination()
    found = j.read_process_state(spark, f"{folder}/state", 500, 600, at(420))
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in expected.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_process_state_in_any_arrival_order(spark, folder, seed):
    """After every batch the state equals the batch operator over all readings so far, late idle ones included."""
    rng = random.Random(seed)
    rows = [reading(i, rng.choice(schemas.SENSOR_TYPES), i, i, order=None if rng.random() < 0.12 else "o",
                    oven=rng.choice(["oven-01", "oven-01", "oven-02"])) for i in range(90)]
    rows += [reading(200 + i, "moisture", 7, rng.choice([5, 40, 89]), order=rng.choice([None, "o"])) for i in range(6)]
    rng.shuffle(rows)
    for i in range(5):
        part = rows[i * len(rows) // 5:(i + 1) * len(rows) // 5]
        readings(spark, part + part[:2]).write.mode("append").parquet(f"{folder}/landing")
        stream = spark.readStream.schema(schemas.READING).parquet(f"{folder}/landing")
        j.start(j.process_state_stream(stream, f"{folder}/state", 4, most_parts=1), f"{folder}/progress").awaitTermination()
        found = j.read_process_state(spark, f"{folder}/state", 500, 600, at(99))
        expected = st.process_state(readings(spark, rows[:(i + 1) * len(rows) // 5]), 500, 600, at(99))
        assert {tuple(r) for r in found.collect()} == {tuple(r) for r in expected.collect()}


def test_quarantine_is_readable_before_the_first_reject(spark, folder):
    assert j.read_quarantine(spark, f"{folder}/none").count() == 0


def test_restarts_and_repeated_ends(spark, folder):
    log = [event(1, "cycle_started", "A"), event(2, "cycle_aborted", "A", 50), event(3, "cycle_started", "A", 100),
           event(4, "cycle_confirmed", "A", 300, payload=CONFIRMED), event(5, "cycle_confirmed", "A", 330, payload=CONFIRMED),
           event(6, "cycle_confirmed", "P", -5, payload=CONFIRMED), event(7, "cycle_started", "P"),
           event(8, "cycle_confirmed", "P", 200, payload=CONFIRMED), event(9, "cycle_started", "T"), event(10, "cycle_timeout", "T", 650),
           event(11, "cycle_started", "Z", 20000), event(12, "cycle_confirmed", "Z", 20010, payload=CONFIRMED)]
    df = events(spark, log)
    land(df, f"{folder}/p", 1, lambda x: j.append_sink(x, f"{folder}/p/out"), lambda x: j.pair_stream(x, "10 hours"))
    pairs = {(r.order_id, r.cycle_start_time, r.cycle_end_time) for r in spark.read.parquet(f"{folder}/p/out").collect()}
    assert pairs == {("A", at(0), at(300)), ("A", at(0), at(330)), ("A", at(100), at(300)), ("A", at(100), at(330)),
                     ("P", at(0), at(200)), ("Z", at(20000), at(20010))}
    limits = spark.createDataFrame([(x, 600) for x in "APTZ"], "order_id string, max_cycle_minutes int")
    land(df, f"{folder}/t", 1, lambda x: j.append_sink(x, f"{folder}/t/out"), lambda x: j.timeout_stream(x, limits))
    late = {(r.order_id, r.timeout_at) for r in spark.read.parquet(f"{folder}/t/out").collect()}
    assert late == {("T", at(600))}


def test_extensions_move_deadlines(spark, folder):
    """In time, late, twice, before a second start, for an order that ends after all; in one arrival and in four."""
    log = [event(1, "cycle_started", "none"), event(2, "cycle_started", "early"), event(3, "cycle_started", "late"),
           event(4, "cycle_started", "both"), event(5, "cycle_started", "ends"), event(6, "cycle_confirmed", "ends", 700, payload=CONFIRMED),
           event(7, "cycle_started", "again"), event(8, "cycle_started", "again", 500), event(9, "cycle_started", "free"),
           event(10, "cycle_confirmed", "early", 760, payload=CONFIRMED), event(11, "cycle_started", "end", 20000),
           event(12, "cycle_aborted", "late", 790), event(3, "cycle_started", "late")]
    more = [("x1", "early", 590, 100), ("x2", "late", 640, 180), ("x3", "both", 600, 60), ("x4", "both", 700, 60), ("x4", "both", 700, 60),
            ("x5", "ends", 10, 200), ("x6", "again", 510, 50), ("x7", "nobody", 10, 10), ("x8", "free", 10, 10)]
    limits = spark.createDataFrame([(x, 600) for x in ("none", "early", "late", "both", "ends", "again", "end")],
                                   "order_id string, max_cycle_minutes int")
    longer = spark.createDataFrame([(i, o, at(m), n) for i, o, m, n in more],
                                   "extension_id string, order_id string, extended_at timestamp, minutes int")
    expected = {("none", at(600), 600), ("early", at(700), 700), ("late", at(600), 600), ("late", at(780), 780), ("both", at(660), 660),
                ("both", at(720), 720), ("again", at(600), 600), ("again", at(1150), 650)}
    everything = [("e", r[5], r) for r in log] + [("x", r[2], r) for r in longer.collect()]
    for parts in (1, 4):
        out, rows = f"{folder}/{parts}", sorted(everything, key=lambda r: r[1])
        for i in range(parts):
            chunk = rows[i * len(rows) // parts:(i + 1) * len(rows) // parts]
            events(spark, [r for k, _, r in chunk if k == "e"]).write.mode("append").parquet(f"{out}/log")
            spark.createDataFrame([r for k, _, r in chunk if k == "x"], longer.schema).write.mode("append").parquet(f"{out}/longer")
            live = j.timeout_stream(spark.readStream.schema(schemas.EVENT).parquet(f"{out}/log"), limits,
                                    spark.readStream.schema(longer.schema).parquet(f"{out}/longer"), "1 hour", "30 days")
            with j.rocksdb(spark):
                j.start(j.append_sink(live, f"{out}/found"), f"{out}/progress").awaitTermination()
        found = [(r.order_id, r.timeout_at, r.max_cycle_minutes) for r in spark.read.parquet(f"{out}/found").collect()]
        assert sorted(found) == sorted(expected)


def test_timeouts_of_many_orders_share_a_state(spark, folder):
    """One state and one timer per group of orders, not per order; the reports are the same, in one arrival and in three."""
    names = [f"o{i}" for i in range(60)]
    log = [event(i, "cycle_started", x, i) for i, x in enumerate(names)]
    log += [event(100 + i, "cycle_confirmed", x, 300 + i, payload=CONFIRMED) for i, x in enumerate(names) if i % 3 == 0]
    log += [event(200 + i, "cycle_aborted", x, 900 + i) for i, x in enumerate(names) if i % 3 == 1] + [event(300, "cycle_started", "end", 5000)]
    limits = spark.createDataFrame([(x, 600) for x in names], "order_id string, max_cycle_minutes int")
    expected = sorted((x, at(i), at(i + 600), 600) for i, x in enumerate(names) if i % 3)
    limits = limits.unionByName(spark.createDataFrame([("end", 600)], limits.schema))
    for parts in (1, 3):
        out = f"{folder}/{parts}"
        for i in range(parts):
            events(spark, log[i * len(log) // parts:(i + 1) * len(log) // parts]).write.mode("append").parquet(f"{out}/log")
            live = j.timeout_stream(spark.readStream.schema(schemas.EVENT).parquet(f"{out}/log"), limits, keep="30 days", groups=3)
            with j.rocksdb(spark):
                query = j.start(j.append_sink(live, f"{out}/found"), f"{out}/progress")
                query.awaitTermination()
        assert sorted(tuple(r) for r in spark.read.parquet(f"{out}/found").collect()) == expected
        # Groups and their timers (each kept under two keys), however many orders there are.
        assert 0 < query.lastProgress.stateOperators[0].numRowsTotal <= 9


def test_upsert_ties(spark, folder):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v long, x string")
    for version in ("v", None):
        target = f"{folder}/{version}"
        t.upsert_latest(rows(("k", 1, "old"), ("l", 5, "high")), target, ["k"], version, 2)
        t.upsert_latest(rows(("k", 1, "new"), ("l", 4, "low")), target, ["k"], version, 2)
        found = {r.k: r.x for r in t.read_upserted(spark, target).collect()}
        assert found == {"k": "new", "l": "high" if version else "low"}


@pytest.mark.parametrize("seed", [6, 7])
def test_alerts_equal_batch(spark, folder, seed):
    """Readings in random order within the delay, the phase fed in, a batch that is repeated with a lost checkpoint."""
    rng = random.Random(seed)
    rows = [reading(i, rng.choice(schemas.SENSOR_TYPES), rng.randrange(80, 130), 3 * i, order=f"o{i // 100}") for i in range(300)]
    rows += [reading(900, order=None)]
    setpoints = spark.createDataFrame([(f"o{i}", 85.0) for i in range(3)], "order_id string, setpoint_vacuum_mbar double")
    cycles = spark.createDataFrame([(f"o{i}", at(300 * i), t) for i, t in enumerate((85, 10, 500))],
                                   "order_id string, cycle_start_time timestamp, target_moisture_ppm int")
    rules = {"spike": ts.temperature_spike_rule(30), "stalled": ts.moisture_stalled_rule(5.0, 45), "loss": ts.vacuum_loss_rule(setpoints)}
    arrivals = sorted(rows, key=lambda r: r[8].timestamp() + rng.uniform(0, 100 * 60))
    prepare = lambda r: ts.with_phase(r, cycles)
    job = lambda x: j.alerts_stream(x, f"{folder}/state", f"{folder}/alerts", rules, delay_minutes=101, prepare=prepare, buckets=4)
    land(readings(spark, arrivals), folder, 4, job)
    everything = prepare(readings(spark, rows))
    expected = {(n, r.reading_id) for n, rule in rules.items() for r in rule.find(everything).collect() if r.order_id}
    read = lambda: {(r.rule, r.reading_id) for r in j.read_alerts(spark, f"{folder}/alerts").collect()}
    assert read() == expected and {n for n, _ in expected} == set(rules)
    # What is kept is context, not the cycles.
    kept = t.read_upserted(spark, f"{folder}/state").groupBy("order_id").count().collect()
    assert len(kept) == 3 and max(r["count"] for r in kept if r.order_id != "o2") < 30
    readings(spark, arrivals[-60:]).write.parquet(f"{folder}/repeat")
    again = spark.readStream.schema(schemas.READING).parquet(f"{folder}/repeat")
    j.start(job(again), f"{folder}/again").awaitTermination()
    assert read() == expected


def test_alert_rules_prepare_a_batch_once(spark, folder):
    counted = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(value):
        counted.add(1)
        return value

    rules = {"stalled": ts.moisture_stalled_rule(5.0, 45), "spike": ts.temperature_spike_rule(30)}
    prepare = lambda r: r.withColumn("value", seen.asNondeterministic()("value"))
    rows = [reading(i, "moisture", 500.0, 10 * i) for i in range(12)] + [reading(20 + i, value=100.0 * (i % 2), minutes=i) for i in range(8)]
    land(readings(spark, rows), folder, 1, lambda x: j.alerts_stream(x, f"{folder}/state", f"{folder}/alerts", rules, prepare=prepare, buckets=2))
    assert {r.rule for r in j.read_alerts(spark, f"{folder}/alerts").collect()} == {"stalled", "spike"}
    assert counted.value == len(rows)


def test_windows_pairs_and_timeouts(spark, folder):
    df = readings(spark, [reading(i, value=i, minutes=i) for i in range(30)])
    land(df, f"{folder}/w", 1, lambda x: j.append_sink(x, f"{folder}/w/out"), lambda x: j.channel_window_stats(x))
    found = {(r.window_start, r.n_readings, r.last) for r in spark.read.parquet(f"{folder}/w/out").collect()}
    assert found == {(at(0), 5, 4), (at(5), 5, 9), (at(10), 5, 14)}
    log = [event(1, "cycle_started", "A"), event(1, "cycle_started", "A"), event(2, "cycle_confirmed", "A", 100, payload=CONFIRMED),
           event(3, "cycle_started", "B"), event(4, "cycle_confirmed", "B", 700, payload=CONFIRMED), event(5, "cycle_started", "C"),
           event(6, "cycle_started", "Z", 20000), event(7, "cycle_confirmed", "Z", 20010, payload=CONFIRMED)]
    df = events(spark, log)
    land(df, f"{folder}/p", 1, lambda x: j.append_sink(x, f"{folder}/p/out"), lambda x: j.pair_stream(x, "10 hours"))
    pairs = {(r.order_id, r.cycle_end_time) for r in spark.read.parquet(f"{folder}/p/out").collect()}
    assert pairs == {("A", at(100)), ("Z", at(20010))}
    limits = spark.createDataFrame([(x, 600) for x in "ABCZ"], "order_id string, max_cycle_minutes int")
    land(df, f"{folder}/t", 1, lambda x: j.append_sink(x, f"{folder}/t/out"), lambda x: j.timeout_stream(x, limits))
    late = {(r.order_id, r.timeout_at) for r in spark.read.parquet(f"{folder}/t/out").collect()}
    assert late == {("B", at(600)), ("C", at(600))}


def test_late_report_holds_what_a_stateful_query_drops(spark, folder):
    rng = random.Random(8)
    rows = [reading(i, minutes=i / 3 + rng.choice([0, 0, 0, -40, -20])) for i in range(400)]
    for i in (1, 2, 3):    # the first row of a batch is exactly as old as the watermark
        rows[100 * i] = reading(100 * i, minutes=(max(r[8] for r in rows[:100 * i]) - at()).total_seconds() / 60 - 10)
    for i in range(4):
        readings(spark, rows[100 * i:100 * (i + 1)]).write.mode("append").parquet(f"{folder}/landing")
        live = lambda: spark.readStream.schema(schemas.READING).parquet(f"{folder}/landing")
        j.start(j.late_report(live(), f"{folder}/late"), f"{folder}/progress").awaitTermination()
        with j.rocksdb(spark):
            query = j.start(j.append_sink(j.silver_readings_stream(live()), f"{folder}/silver"), f"{folder}/stateful")
            query.awaitTermination()
        dropped = {r.batch_id: (r.watermark, r.dropped) for r in j.dropped_rows(query).collect()}
        found = t.read_upserted(spark, f"{folder}/late")
        if i:
            number = max(b for b, (_, n) in dropped.items() if n)
            assert dropped[number][0] == found.agg(F.max("watermark")).first()[0]
            assert dropped[number][1] == found.filter(F.col("watermark") == F.lit(dropped[number][0])).count() > 0
    good = {r.reading_id for r in spark.read.parquet(f"{folder}/silver").collect()}
    assert good == {r[0] for r in rows} - {r.reading_id for r in found.collect()}
    before = found.count()
    spark.createDataFrame([], schemas.READING).write.mode("append").parquet(f"{folder}/landing")
    j.start(j.late_report(live(), f"{folder}/late"), f"{folder}/progress").awaitTermination()
    assert t.read_upserted(spark, f"{folder}/late").count() == before


def test_ring_equals_batch(spark, folder):
    rng = random.Random(3)
    rows = [reading(i, rng.choice(["moisture", "vacuum"]), i, rng.randrange(200), oven=rng.choice(["oven-01", "oven-02"])) for i in range(200)]
    land(readings(spark, rows + rows[:20]), folder, 4, lambda x: j.ring_stream(x, f"{folder}/ring", 15, 4))
    found = {r.reading_id for r in t.read_upserted(spark, f"{folder}/ring").collect()}
    assert found == {r.reading_id for r in st.retain_last_n(readings(spark, rows), 15).collect()} and len(found) == 60


def test_eta_follows_the_batch_estimate(spark, folder):
    log, known, rows = cycles(4)
    rows += [reading(700 + i, "moisture", 900 * 0.99 ** i + i % 3, 65 + 7 * i, order=f"ORD-2031-{i % 4:05d}") for i in range(60)]
    stuff, silver = materials(spark), s.silver_cycle_events(events(spark, log[::2]))
    pairs, versions = s.cycle_pairs(silver), s.silver_orders(orders(spark, known))
    spec = lambda: (pairs, versions, stuff)
    targets = pairs.select("order_id", "cycle_start_time", "cycle_end_time").join(versions.select("order_id", "material_id"), "order_id").join(
        stuff.select("material_id", "target_moisture_ppm"), "material_id").drop("material_id")
    seen = []
    for part in (rows[:50], rows[50:]):
        seen += part
        readings(spark, part).write.mode("append").parquet(f"{folder}/landing")
        stream = spark.readStream.schema(schemas.READING).parquet(f"{folder}/landing")
        j.start(j.eta_stream(stream, spec, f"{folder}/sums", 2, 1), f"{folder}/progress").awaitTermination()
        expected = {r.order_id: r for r in ts.cycle_end_eta(ts.expected_profile(readings(spark, seen), *spec()), targets).collect()}
        found = {r.order_id: r for r in j.read_eta(spark, f"{folder}/sums", targets).collect()}
        assert set(found) == set(expected) and len(found) == 4
        for name, row in found.items():
            assert row.n_readings == expected[name].n_readings
            for c in ("slope", "intercept", "r2", "eta_minutes"):
                assert row[c] == pytest.approx(expected[name][c], rel=1e-9, abs=1e-12)


def test_upsert_is_idempotent_and_recovers(spark, folder):
    target = f"{folder}/orders"
    first = orders(spark, [order(f"o{i}", updated=1) for i in range(50)])
    newer = orders(spark, [order(f"o{i}", status="CLOSED", updated=2) for i in range(40, 60)])
    for df in (first, newer, first, newer):
        t.upsert_latest(df, target, ["order_id"], "updated_at", 8)
    found = {r.order_id: r.status for r in t.read_upserted(spark, target).collect()}
    assert len(found) == 60 and sum(x == "CLOSED" for x in found.values()) == 20
    kept = t.read_upserted(spark, target)
    assert kept.columns == first.columns


def test_snapshot_seed_and_list(spark, folder):
    df = orders(spark, [order("A"), order("B")])
    for hour in (8, 9):
        ref.snapshot_refresh(df, f"{folder}/snap", f"2026-06-03 0{hour}:00:00")
    assert spark.read.parquet(f"{folder}/snap").count() == 2
    seed = [{"order_id": "A", "material_id": "MAT-0001", "planned_start": "2026-06-03T06:00:00Z", "standard_cycle_minutes": 480}]
    spark.createDataFrame([(json.dumps(seed, indent=1),)], "v string").write.text(f"{folder}/seed")
    rows = ref.read_seed(spark, f"{folder}/seed", schemas.ORDER)
    assert rows.first().goods_movement_posted is False and rows.first().planned_start == at(0)
    for _ in range(2):
        ref.load_seed(rows, f"{folder}/bronze", "order_id", f"{folder}/gold")
    assert spark.read.parquet(f"{folder}/bronze").count() == 1
    df.write.parquet(f"{folder}/gold")
    ref.load_seed(df, f"{folder}/bronze", "order_id", f"{folder}/gold")
    assert spark.read.parquet(f"{folder}/bronze").count() == 1
    pages = [json.dumps({"count": n, "value": seed}) for n in (1, 2)]
    spark.createDataFrame([(p,) for p in pages], "v string").repartition(2).write.option("maxRecordsPerFile", 1).text(f"{folder}/list")
    found = ref.read_odata_list(spark, f"{folder}/list", schemas.ORDER).collect()
    assert sorted(r.count_matches for r in found) == [False, True] and found[0].order_id == "A"


def test_capture_and_bronze_append(spark, folder):
    lines = ['factory/a/b/c {"x": 1 }', "no-payload", "", "t  two spaces"]
    spark.createDataFrame([(x,) for x in lines], "v string").write.text(f"{folder}/capture")
    found = {r.line: (r.topic, r.raw_payload) for r in m.read_capture(spark, f"{folder}/capture").collect()}
    assert found == {lines[0]: ("factory/a/b/c", '{"x": 1 }'), "no-payload": (None, None), lines[3]: ("t", " two spaces")}
    df = readings(spark, [reading(1)])
    t.append_bronze(df, f"{folder}/bronze", as_of="2026-06-03 08:00:00")
    t.append_bronze(df, f"{folder}/bronze", as_of="2026-06-04 08:00:00")
    rows = spark.read.parquet(f"{folder}/bronze")
    assert rows.count() == 2 and json.loads(rows.first().raw_payload)["reading_id"] == "r000001"
    for day, number in (("2026-06-03", 3), ("2026-06-04", 3), ("2026-06-04", 4), ("2026-06-04", 5), ("2026-06-05", 6)):
        t.append_bronze(df, f"{folder}/stream", as_of=f"{day} 00:00:01", batch=("s", number), most_parts=1)
    days = [r.ingest_date.isoformat() for r in t.read_bronze(spark, f"{folder}/stream").orderBy("ingested_at").collect()]
    assert days == ["2026-06-03", "2026-06-04", "2026-06-04", "2026-06-05"]    # batch 3 came again after midnight
    manifest = v.snapshot(spark, f"{folder}/stream")
    assert [len(parts) for parts in manifest["buckets"].values()] == [1, 1, 1]
    some = t.read_bronze(spark, f"{folder}/stream", dt.date(2026, 6, 4), dt.date(2026, 6, 4))
    assert some.count() == 2 and len(some.inputFiles()) == 1


def test_mart_prunes_by_plant(spark, folder):
    from test_silver_gold import seed_gold

    t.write_mart(seed_gold(spark), f"{folder}/mart")
    plan = spark.read.parquet(f"{folder}/mart").filter("plant = 'kirchheim'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(plant" in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_state_does_not_depend_on_row_order(spark, seed):
    rows = [reading(i, value=i, minutes=i % 9, order=None if i % 5 == 0 else "o") for i in range(60)]
    expected = {tuple(r) for r in st.process_state(readings(spark, rows), as_of=at(99)).collect()}
    random.Random(seed).shuffle(rows)
    shuffled = readings(spark, rows).repartition(5)
    assert {tuple(r) for r in st.process_state(shuffled, as_of=at(99)).collect()} == expected


def test_state_stores_write_changes(spark, folder):
    """A commit does not write the whole state; rows are counted unless told otherwise; the session is left as it was."""
    settings = lambda: {n: spark.conf.get(n, None) for n in (*j.STATE_SETTINGS, j.ROWS)}
    before = settings()
    with j.rocksdb(spark, count_rows=False):
        assert spark.conf.get(j.ROWS) == "false"
    assert settings() == before
    df = readings(spark, [reading(i, minutes=i) for i in range(20)])
    land(df, folder, 1, lambda x: j.append_sink(x, f"{folder}/out"), lambda x: j.silver_readings_stream(x, "2 hours"))
    assert settings() == before
    stored = [str(f.relative_to(folder)) for f in pathlib.Path(f"{folder}/progress/state").rglob("*.changelog")]
    assert stored and spark.read.parquet(f"{folder}/out").count() == 20


def test_eta_query_computes_its_inputs_once(spark):
    from cyclelake.plans.catalog import stream
    from cyclelake.plans.tables import Lake

    asked = []

    class Counted(Lake):
        def view(self, name, live=()):
            asked.append(name)
            return super().view(name, live)

    assert stream.eta(Counted(spark, "/root/testdata/sf0.001")).count() > 0
    assert sorted(asked) == ["br_events", "br_materials", "br_orders", "br_readings"]


def test_gold_stream_drops_only_keys_that_wait(spark, folder, monkeypatch):
    """Orders that never waited are not written to the table of waiting orders."""
    log, known, rows = cycles(6)
    dropped, replace = [], j.replace_keys
    monkeypatch.setattr(j, "replace_keys", lambda keys, *args: dropped.append({r.order_id for r in keys.collect()}) or replace(keys, *args))
    present = known[:4]
    run = gold_job(spark, folder, lambda changed: (s.silver_orders(orders(spark, present)), materials(spark), None))
    events(spark, log).write.parquet(f"{folder}/log")
    readings(spark, rows[:20]).write.mode("append").parquet(f"{folder}/series")
    run()
    assert dropped[0] == set() and t.read_upserted(spark, f"{folder}/gold").count() == 4
    late = {r.order_id for r in t.read_upserted(spark, f"{folder}/pending").collect()}
    present = known
    readings(spark, rows[20:]).write.mode("append").parquet(f"{folder}/series")
    run()
    assert dropped[-1] == late and {o[0] for o in known[4:]} <= late
    assert t.read_upserted(spark, f"{folder}/gold").count() == 6 and t.read_upserted(spark, f"{folder}/pending").count() == 0
