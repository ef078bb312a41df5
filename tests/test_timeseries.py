import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import at, event, events, materials, order, orders, reading, readings
from cyclelake.operators import silver as s
from cyclelake.operators import state as st
from cyclelake.operators import timeseries as ts


def expected(spark, sensor, minutes, temperature=130.0, vacuum=5.0, moisture=300.0, standard=480.0):
    df = spark.createDataFrame([(sensor, float(t), temperature, vacuum, moisture, standard) for t in minutes],
                               "s string, t double, a double, b double, c double, d double")
    return [r[0] for r in df.select(ts.expected_value("s", "t", "a", "b", "c", "d")).collect()]


def test_curve_shapes(spark):
    heat = expected(spark, "temperature", [0, 10, 30, 60, 61, 400])
    assert heat[0] == 25.0 and heat == sorted(heat) and heat[-1] == heat[-2] == 130.0
    assert heat[3] == pytest.approx(25 + 105 * (1 - math.exp(-3)))
    pull = expected(spark, "vacuum", [0, 60, 61, 70, 90, 600])
    assert pull[:2] == [1013.0, 1013.0] and pull == sorted(pull, reverse=True) and pull[-1] == pytest.approx(5.0)
    decay = expected(spark, "moisture", [60, 300, 540, 700])
    assert decay[0] == 5000 and decay[2] == pytest.approx(300) and decay[3] < 300


def test_a_cycle_on_the_curve(spark):
    minutes = list(range(0, 541, 5))
    curve = expected(spark, "moisture", minutes)
    rows = [reading(i, "moisture", v, t) for i, (t, v) in enumerate(zip(minutes, curve))]
    pairs = s.cycle_pairs(events(spark, [event(1, "cycle_started")]).withColumn("sap_confirmation_number", F.lit(None)))
    profile = ts.expected_profile(readings(spark, rows), pairs, orders(spark, [order()]), materials(spark))
    worst = ts.profile_residual(profile).agg(F.max(F.abs("residual")), F.max(F.abs("z_score"))).first()
    assert worst[0] == pytest.approx(0, abs=1e-9) and worst[1] == pytest.approx(0, abs=1e-9)
    targets = pairs.select("order_id", "cycle_start_time").withColumn("target_moisture_ppm", F.lit(300))
    eta = ts.cycle_end_eta(profile.filter("elapsed_minutes < 200"), targets).first()
    assert eta.eta_minutes == pytest.approx(540, abs=1e-6) and eta.r2 == pytest.approx(1)
    assert abs((eta.eta - at(540)).total_seconds()) < 0.01
    flat = profile.withColumn("value", F.lit(700.0))
    assert ts.cycle_end_eta(flat, targets).first().eta_minutes is None


@pytest.mark.parametrize("alpha", [0.05, 0.3, 0.9, 1.0])
def test_ewma_against_a_loop(spark, alpha):
    rng = random.Random(3)
    rows = [reading(i, value=rng.uniform(-5, 100), minutes=i % 700, oven=f"oven-0{i % 3 // 2}") for i in range(2500)]
    found = {r.reading_id: r.ewma for r in ts.ewma(readings(spark, rows), alpha, ["oven_id"]).collect()}
    for oven in ("oven-00", "oven-01"):
        mean = None
        for r in sorted((r for r in rows if r[2] == oven), key=lambda r: (r[8], r[0])):
            mean = r[5] if mean is None else alpha * r[5] + (1 - alpha) * mean
            assert found[r[0]] == pytest.approx(mean, rel=1e-12, abs=1e-12)
    with pytest.raises(ValueError):
        ts.ewma(readings(spark, rows), 0)


def test_stalled_moisture_against_a_loop(spark):
    rng = random.Random(5)
    rows = [reading(i, "moisture", rng.randrange(80, 120), rng.randrange(0, 900), order=f"o{i % 3}") for i in range(400)]
    found = {r.reading_id: r.window_start_value for r in ts.alert_moisture_stalled(readings(spark, rows), 5, 30).collect()}
    wanted = {}
    for r in rows:
        before = [x for x in rows if x[1] == r[1] and (r[8] - x[8]).total_seconds() >= 1800]
        first = max(before, key=lambda x: (x[8], x[0]), default=None)
        if first and r[5] > first[5] * 0.95:
            wanted[r[0]] = first[5]
    assert found == wanted and found


def test_a_healthy_cycle_raises_no_stall(spark):
    minutes = [k / 2 for k in range(0, 481)]
    curve = expected(spark, "moisture", minutes)
    rows = [reading(i, "moisture", v, t) for i, (t, v) in enumerate(zip(minutes, curve))]
    df = readings(spark, rows)
    pairs = s.cycle_pairs(events(spark, [event(1, "cycle_started")]).withColumn("sap_confirmation_number", F.lit(None)))
    tagged = st.cycle_phase(df, pairs, orders(spark, [order()]), materials(spark))
    assert ts.alert_moisture_stalled(tagged).count() == 0
    stuck = tagged.withColumn("value", F.when(F.col("elapsed_minutes") > 150, F.lit(900.0)).otherwise(F.col("value")))
    assert ts.alert_moisture_stalled(stuck).count() > 0


def test_spikes_and_vacuum_loss(spark):
    rows = [reading(0, value=100), reading(1, value=119, minutes=5), reading(2, value=140, minutes=500),
            reading(3, value=133, minutes=505)]
    setpoint = spark.createDataFrame([("ORD-2031-07315", 130.0, 5.0)],
                                     "order_id string, setpoint_temperature_degC double, setpoint_vacuum_mbar double")
    found = {r.reading_id: r.reason for r in ts.alert_temperature_spike(readings(spark, rows), 20, setpoints=setpoint).collect()}
    assert found == {"r000002": "jump", "r000003": "above setpoint"}
    rows = [reading(i, "vacuum", v, 100 * i) for i, v in enumerate([1013, 40, 5.4, 5.5, 5.6, 900])]
    found = ts.alert_vacuum_loss(readings(spark, rows), setpoint).collect()
    assert {r.reading_id for r in found} == {"r000004", "r000005"}


def test_resample_marks_gaps(spark):
    rows = [reading(0, value=1, minutes=1), reading(1, value=2, minutes=4), reading(2, value=3, minutes=26)]
    for chunk in (1, 2, 1000):
        found = ts.resample(readings(spark, rows), 5, gap_slots=chunk).orderBy("bucket").collect()
        assert [(r.value, r.n_readings, r.is_gap) for r in found] == [
            (2, 2, False), (None, 0, True), (None, 0, True), (None, 0, True), (None, 0, True), (3, 1, False)]
        assert [r.bucket for r in found] == [at(5 * i) for i in range(6)]


def test_minutes(spark):
    row = spark.range(1).select(ts.simulated_minutes(F.lit(2.0)), ts.wall_minutes(F.lit(480.0)), ts.simulated_minutes(F.lit(1.0), 10)).first()
    assert tuple(row) == (120, 8, 10)


def test_ingest_lag(spark):
    df = readings(spark, [reading(i) for i in range(100)])
    number = F.substring("reading_id", 2, 6).cast("int")
    df = df.withColumn("ingested_at", F.col("timestamp_opc") + F.make_dt_interval(secs=number))
    row = ts.ingest_lag(df, end="ingested_at").first()
    assert (row.n_readings, row.max_seconds, row.over_10s, row.over_60s) == (100, 99, 89, 39)
    assert (row.p50_seconds, row.p95_seconds) == (49, 94)
