import json

import pytest
from pyspark.sql import functions as F

from conftest import MATERIALS, at, event, events, materials, order, orders, reading, readings
from cyclelake import schemas
from cyclelake.operators import contracts, dashboards as d, gold as g, silver as s

CONFIRMED = '{"sap_confirmation_number": "CONF-2031-55102", "goods_movement_document": "GR-2031-700412"}'


def lake(spark, rows=None, log=None, known=None):
    rows = rows or [
        reading(1, "temperature", 120, 10), reading(2, "temperature", 131, 20), reading(3, "vacuum", 6, 30),
        reading(4, "moisture", 900, 40), reading(5, "moisture", 299, 400), reading(6, "moisture", 10, 500, quality="Bad"),
    ]
    log = log or [event(1, "cycle_started"), event(2, "cycle_confirmed", minutes=450, payload=CONFIRMED)]
    known = known or [order()]
    return (
        s.cycle_pairs(s.silver_cycle_events(events(spark, log))), s.silver_orders(orders(spark, known)),
        s.silver_materials(materials(spark)), s.silver_readings(readings(spark, rows)),
    )


def test_silver_readings_dedupe_is_stable(spark):
    rows = [reading(i % 40, value=i, seconds=i) for i in range(400)]
    rows += [reading(500, quality="Bad"), (*reading(501)[:5], None, *reading(501)[6:])]
    expected = {(r.reading_id, r.value) for r in s.silver_readings(readings(spark, rows)).collect()}
    assert expected == {(f"r{i:06d}", float(i)) for i in range(40)}
    shuffled = readings(spark, rows[::-1]).repartition(7)
    assert {(r.reading_id, r.value) for r in s.silver_readings(shuffled).collect()} == expected


def test_copies_are_limited_before_the_shuffle(spark):
    plan = s.silver_readings(readings(spark, [reading(1)]).repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_gold_row(spark):
    row = g.gold_cycle_summary(*lake(spark)).first()
    assert (row.actual_duration_minutes, row.delta_minutes) == (450, -30)
    assert (row.peak_temperature_degC, row.min_vacuum_mbar, row.final_moisture_ppm) == (131, 6, 299)
    assert row.avg_moisture_ppm == (900 + 299) / 2
    assert row.spec_met is True and row.temperature_limit_met is False
    assert (row.operator_id, row.sap_confirmation_number) == ("OP-431", "CONF-2031-55102")
    assert g.gold_cycle_summary(*lake(spark), tolerance=1.0).first().temperature_limit_met is True
    assert g.gold_cycle_summary(*lake(spark)).schema.names == schemas.GOLD.names


def test_spec_is_strict_and_null_without_moisture(spark):
    row = g.gold_cycle_summary(*lake(spark, [reading(1, "moisture", 300, 5)])).first()
    assert row.spec_met is False
    row = g.gold_cycle_summary(*lake(spark, [reading(1, "vacuum", 3, 5)])).first()
    assert row.spec_met is None and row.final_moisture_ppm is None


@pytest.mark.parametrize("log", [
    [event(1, "cycle_started")], [event(2, "cycle_confirmed", minutes=5)],
    [event(1, "cycle_started", minutes=9), event(2, "cycle_confirmed", minutes=5)],
])
def test_only_whole_cycles_reach_gold(spark, log):
    assert g.gold_cycle_summary(*lake(spark, log=log)).count() == 0


def test_repeated_events(spark):
    log = [event(1, "cycle_started", minutes=5), event(2, "cycle_started", minutes=3), event(2, "cycle_started", minutes=3),
           event(3, "cycle_confirmed", minutes=100, operator="OP-1"), event(4, "cycle_confirmed", minutes=200, operator="OP-2")]
    pair = s.cycle_pairs(s.silver_cycle_events(events(spark, log))).first()
    assert (pair.cycle_start_time, pair.cycle_end_time, pair.operator_id) == (at(3), at(200), "OP-2")
    assert {(r.event_type, r.n_rows) for r in s.key_violations(
        s.silver_cycle_events(events(spark, log)), ["order_id", "event_type"]).collect()} == {
        ("cycle_started", 2), ("cycle_confirmed", 2)}


def test_bounded_stats(spark):
    pairs, _, _, rows = lake(spark, [reading(1, "moisture", 5, -1), reading(2, "moisture", 7, 450), reading(3, "moisture", 9, 451)])
    assert g.cycle_sensor_stats(rows).first().final_moisture_ppm == 9
    bounded = g.cycle_sensor_stats(rows, pairs).first()
    assert (bounded.final_moisture_ppm, bounded.avg_moisture_ppm) == (7, 7)


def test_latest_version_wins(spark):
    known = [order(status="CREATED", updated=1), order(status="CONFIRMED", updated=9), order(status="RELEASED", updated=5)]
    assert s.silver_orders(orders(spark, known)).first().status == "CONFIRMED"


def test_to_utc(spark):
    texts = ["2026-06-03T08:32:14.521Z", "2026-06-03T10:32:14.521+02:00", "2026-06-03T08:32:14.521", "soon"]
    df = s.normalise_timestamps(spark.createDataFrame([(t,) for t in texts], "t string"), ["t"])
    found = [r.t for r in df.collect()]
    assert found[0] == found[1] == found[2] and found[3] is None


def seed_gold(spark):
    """Twenty cycles in the seed's shape: 6/6/4/4 per material, of which 5/6/3/3 meet the spec."""
    rows, n = [], 0
    for (material, text, _, target, standard, *_), cycles, met in zip(MATERIALS, (6, 6, 4, 4), (5, 6, 3, 3)):
        for i in range(cycles):
            n += 1
            delta = (-17, 82, 0, 5, 30, -60)[i]
            final = target - 10 if i < met else target + 10
            rows.append((f"ORD-2026-{n:05d}", material, text, "regensburg", "oven-01", at(1440 * n),
                         at(1440 * n + standard + delta), float(standard + delta), standard, float(delta), 121.4, 7.8,
                         float(final), 900.0, target, final < target, True, True, "OP-003", f"CONF-2026-{n:05d}", True))
    return spark.createDataFrame(rows, schemas.GOLD)


def test_efficiency_of_the_seed(spark):
    found = {r.material_id: (r.total_cycles, r.cycles_meeting_moisture_spec, r.pct_spec_met)
             for r in g.v_cycle_efficiency(seed_gold(spark)).collect()}
    assert found == {"MAT-0001": (6, 5, 500 / 6), "MAT-0002": (6, 6, 100.0), "MAT-0003": (4, 3, 75.0), "MAT-0004": (4, 3, 75.0)}


def test_seed_passes_the_gold_contract(spark):
    checked = contracts.validate_gold(contracts.gold_as_json(seed_gold(spark)))
    assert [r.errors for r in checked.filter("not is_valid").collect()] == []


def test_recent_cycles_and_colours(spark):
    gold = seed_gold(spark)
    recent = g.v_recent_cycles(gold, 3).collect()
    assert [r.order_id for r in recent] == ["ORD-2026-00020", "ORD-2026-00019", "ORD-2026-00018"]
    colours = {r.order_id: r.colour for r in d.cycle_overview(gold).collect()}
    assert colours["ORD-2026-00001"] == "green" and colours["ORD-2026-00002"] == "red"
    assert colours["ORD-2026-00004"] == "amber" and colours["ORD-2026-00006"] == "red"


def test_filters(spark):
    gold = seed_gold(spark)
    assert d.filter_cycles(gold, as_of=at(1440 * 100)).count() == 11
    assert d.filter_cycles(gold, at(0), at(1440 * 30)).count() == 20
    assert d.filter_cycles(gold, at(0), at(1440 * 30), ["MAT-0002"], ["kirchheim"]).count() == 0
    assert d.filter_cycles(gold, at(0), at(1440 * 30), outcome="spec failed").count() == 3
    with pytest.raises(ValueError):
        d.filter_cycles(gold, outcome="good")
    assert d.filter_options(gold).count() == 5


def test_waste_and_crossing(spark):
    pairs, known, stuff, rows = lake(spark, [reading(1, "moisture", 900, 100), reading(2, "moisture", 299, 360),
                                             reading(3, "moisture", 200, 400)])
    gold = g.gold_cycle_summary(pairs, known, stuff, rows)
    row = d.drying_waste(gold, rows).first()
    assert (row.waste_minutes, row.waste_share) == (90, 90 / 450)
    series = d.cycle_series(gold, rows).orderBy("elapsed_minutes").collect()
    assert [r.elapsed_minutes for r in series] == [100, 360, 400] and series[0].temperature is None


def test_incremental_equals_full(spark):
    log, known, rows = [], [], []
    for i in range(12):
        name = f"ORD-2026-{i:05d}"
        known.append(order(name, MATERIALS[i % 4][0]))
        log += [event(2 * i, "cycle_started", name, i), event(2 * i + 1, "cycle_confirmed", name, 300 + i, payload=CONFIRMED)]
        rows += [reading(10 * i + j, "moisture", 1000 - 300 * j + i, 60 * j, order=name) for j in range(4)]
    full = g.gold_cycle_summary(*lake(spark, rows, log, known))
    touched = events(spark, log[:6]).select("order_id")
    pairs, versions, stuff, silver = lake(spark, rows, log, known)
    part = g.gold_incremental(g.touched_orders(touched), s.silver_cycle_events(events(spark, log)), versions, stuff, silver)
    expected = {r.order_id: r for r in full.collect()}
    found = part.collect()
    assert len(found) == 3 and all(expected[r.order_id] == r for r in found)


def test_payload_columns(spark):
    log = [event(1, "cycle_timeout", payload='{"elapsed_minutes": 610, "max_cycle_minutes": 600}'),
           event(2, "cycle_aborted", payload='{"reason": "stop"}'), event(3, "cycle_started", payload="not json"),
           event(4, "cycle_started", payload=json.dumps({"setpoint_temperature_degC": 130, "setpoint_vacuum_mbar": 5.5}))]
    rows = {r.event_id: r for r in s.parse_event_payload(events(spark, log)).collect()}
    assert (rows["e000001"].elapsed_minutes, rows["e000002"].reason) == (610, "stop")
    assert rows["e000003"].setpoint_vacuum_mbar is None and rows["e000004"].setpoint_temperature_degC == 130.0
    variant = events(spark, log[-1:]).withColumn("payload", F.parse_json("payload"))
    assert s.parse_event_payload(variant).first().setpoint_vacuum_mbar == 5.5
