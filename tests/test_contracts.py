import copy
import json

import pytest

from conftest import materials, order, orders, reading, readings
from cyclelake.operators import contracts as c
from cyclelake.sources import messages as m

# One correct message per contract.
GOOD = {
    "C1": {"reading_id": "0b9e77c1-52d8-4f06-9a1c-3de84c7f2b60", "timestamp_opc": "2031-11-19T04:17:50.25Z",
           "timestamp_mqtt": "2031-11-19T04:17:50Z", "plant": "regensburg", "oven_id": "oven-01",
           "sensor_type": "temperature", "value": 97.6, "unit": "degC", "quality": "Good", "order_id": None},
    "C2": {"oven_id": "oven-01", "order_id": "ORD-2031-07315", "status": "running", "temperature_degC": 88.2,
           "vacuum_mbar": 4, "moisture_ppm": None, "cycle_elapsed_minutes": 131.9, "moisture_threshold_met": False,
           "timestamp": "2031-11-19T04:17:50Z"},
    "C3": {"order_id": "ORD-2031-07315", "count": 1, "readings": [
        {"reading_id": "0b9e77c1-52d8-4f06-9a1c-3de84c7f2b60", "timestamp_opc": "2031-11-19T03:25:00Z",
         "sensor_type": "temperature", "value": 64.4, "unit": "degC", "quality": "Good"}]},
    "C4": {"order_id": "ORD-2031-07315", "status": "in-progress", "operator_id": "OP-431", "cycle_confirmed_at": None,
           "quality_check_passed": None},
    "C5": {"order_id": "ORD-2031-07315", "sap_confirmation_number": "CONF-2031-55102", "status": "CONFIRMED",
           "posted_at": "2031-11-19T16:41:02Z"},
    "C6": {"order_id": "ORD-2031-07315", "material_id": "MAT-0001", "plant": "regensburg", "oven_id": "oven-01",
           "planned_start": "2031-11-19T02:40:00Z", "planned_end": "2031-11-19T10:40:00Z", "standard_cycle_minutes": 480,
           "status": "RELEASED", "operator_id": None, "actual_start": None, "actual_end": None,
           "sap_confirmation_number": None, "goods_movement_posted": False, "created_at": "2031-11-17T15:20:00Z",
           "updated_at": "2031-11-17T15:20:00Z"},
    "C7": {"material_id": "MAT-0001", "material_description": "Reactor coil", "insulation_class": "F",
           "target_moisture_ppm": 410, "standard_cycle_minutes": 335, "max_cycle_minutes": 505,
           "target_temperature_degC": 118.5, "target_vacuum_mbar": 7, "weight_kg": 2150.5, "updated_at": "2031-11-16T09:10:00Z"},
    "C8": {"document_number": "GR-2031-700412", "order_id": "ORD-2031-07315", "material_id": "MAT-0001",
           "movement_type": "GR_PRODUCTION", "quantity": 1, "unit": "EA", "posting_date": "2031-11-19",
           "storage_location": "WH-01", "posted_at": "2031-11-19T16:41:09Z", "status": "posted"},
    "C10": {"event_id": "5d20f3aa-9b41-4c8e-8e77-61c0a9f4e233", "event_type": "cycle_started", "order_id": "ORD-2031-07315",
            "oven_id": "oven-01", "operator_id": "OP-431", "timestamp": "2031-11-19T02:45:00Z",
            "payload": {"setpoint_temperature_degC": 130, "setpoint_vacuum_mbar": 5.0}},
    "C12": {"order_id": "ORD-2031-07290", "material_id": "MAT-0002", "material_description": "Distribution", "plant": "regensburg",
            "oven_id": "oven-01", "operator_id": "OP-118", "cycle_start_time": "2031-11-18T01:10:00Z",
            "cycle_end_time": "2031-11-18T05:02:00Z", "actual_duration_minutes": 232, "standard_cycle_minutes": 250,
            "delta_minutes": -18, "peak_temperature_degC": 109.8, "min_vacuum_mbar": 6.3, "final_moisture_ppm": 387,
            "target_moisture_ppm": 500, "spec_met": True, "sap_confirmation_number": "CONF-2031-55077",
            "goods_movement_posted": True},
}
# (contract, field path, new value, number of broken rules); "-" removes the field.
CASES = [
    ("C1", "reading_id", "0b9e77c1-52d8-7f06-9a1c-3de84c7f2b60", 1), ("C1", "reading_id", "0B9E77C1-52D8-4F06-9A1C-3DE84C7F2B60", 0),
    ("C1", "order_id", 5, 1), ("C1", "oven_id", "oven-1", 1), ("C1", "plant", "paris", 1), ("C1", "value", "1.5", 1),
    ("C1", "value", True, 1), ("C1", "value", 3, 0), ("C1", "unit", "ppm", 1), ("C1", "unit", "bar", 1), ("C1", "quality", None, 1),
    ("C1", "timestamp_opc", "2031-11-19T04:17:50+00:00", 1), ("C1", "_meta", {"a": 1}, 1), ("C1", "value", "-", 1),
    ("C2", "order_id", None, 0), ("C2", "order_id", "ORD-26-1", 1), ("C2", "status", "fault", 1), ("C2", "vacuum_mbar", "4", 1),
    ("C2", "cycle_elapsed_minutes", -0.1, 1), ("C2", "moisture_threshold_met", 1, 1), ("C2", "temperature_degC", "-", 0),
    ("C3", "count", 2, 1), ("C3", "count", -1, 2), ("C3", "count", 1.0, 1), ("C3", "readings", {}, 1), ("C3", "readings", [7], 1),
    ("C3", "readings", [], 1), ("C3", "readings", [{}], 6),
    ("C4", "status", "CLOSED", 1), ("C4", "operator_id", 3, 1), ("C4", "cycle_confirmed_at", "soon", 1), ("C4", "quality_check_passed", "yes", 1),
    ("C5", "status", "-", 2), ("C5", "posted_at", "2031-11-19 16:41:02", 1), ("C5", "sap_confirmation_number", "CONF-2031-551", 1),
    ("C6", "actual_end", "-", 1), ("C6", "actual_end", "2031-11-19T10:40:00Z", 0), ("C6", "standard_cycle_minutes", 0, 1),
    ("C6", "standard_cycle_minutes", 480.5, 1), ("C6", "status", "RUNNING", 1), ("C6", "goods_movement_posted", "no", 1), ("C6", "operator_id", 1, 1),
    ("C7", "material_description", "", 1), ("C7", "max_cycle_minutes", 335, 1), ("C7", "max_cycle_minutes", "-", 3),
    ("C7", "target_vacuum_mbar", -5, 1), ("C7", "weight_kg", "8500", 1), ("C7", "max_cycle_minutes", None, 1),
    ("C8", "movement_type", "GI", 1), ("C8", "quantity", 0, 1), ("C8", "posting_date", "19.11.2031", 1), ("C8", "unit", "-", 2),
    ("C10", "event_type", "order_started", 1), ("C10", "payload", None, 1), ("C10", "payload", "x", 1), ("C10", "payload", {}, 2),
    ("C10", "payload", {"setpoint_temperature_degC": "a", "setpoint_vacuum_mbar": True}, 2), ("C10", "operator_id", [], 1),
    ("C12", "delta_minutes", -19, 0), ("C12", "delta_minutes", -20, 1), ("C12", "spec_met", False, 1), ("C12", "final_moisture_ppm", None, 1),
    ("C12", "cycle_end_time", "2031-11-18T05:02:00.5Z", 0), ("C12", "order_id", "-", 2), ("C12", "operator_id", "-", 0),
    ("C12", "target_moisture_ppm", 500.5, 1),
]


@pytest.mark.parametrize("contract", list(GOOD))
def test_cases(spark, contract):
    texts, expected = [json.dumps(GOOD[contract]), "not json", "[1]", "null", '{"value": NaN}'], [0, 1, 1, 1, 1]
    for _, field, value, n in (x for x in CASES if x[0] == contract):
        message = copy.deepcopy(GOOD[contract])
        if value == "-":
            del message[field]
        else:
            message[field] = value
        texts.append(json.dumps(message))
        expected.append(n)
    df = spark.createDataFrame(list(enumerate(texts)), "n int, raw_payload string")
    checked = c.VALIDATORS[contract](df).orderBy("n").collect()
    assert [(r.raw_payload, len(r.errors)) for r in checked] == list(zip(texts, expected))
    assert all(r.is_valid == (not r.errors) for r in checked)
    valid = c.VALIDATORS[contract](df).filter("is_valid").count()
    assert valid == expected.count(0)


def test_unexpected_fields_may_be_allowed(spark):
    df = spark.createDataFrame([(json.dumps({**GOOD["C1"], "_meta": 1}),)], "raw_payload string")
    assert c.validate_reading(df).first().errors == ["unexpected fields: _meta"]
    assert c.validate_reading(df, strict_fields=False).first().is_valid


def test_summary_and_ranking(spark):
    bad = copy.deepcopy(GOOD["C3"])
    bad["readings"] = [{**bad["readings"][0], "unit": "bar"}] * 3
    bad["count"] = 3
    df = spark.createDataFrame([("t1", json.dumps(GOOD["C3"])), ("t1", json.dumps(bad))], "topic string, raw_payload string")
    checked = c.validate_historian_response(df)
    assert c.validation_summary(checked, "topic").first().asDict() == {"topic": "t1", "passed": 1, "failed": 1, "total": 2}
    assert [(r.rule[:14], r.n) for r in c.failing_rules(checked).collect()] == [("readings[].uni", 3)]


def test_references_and_ranges(spark):
    rows = readings(spark, [reading(1), reading(2, order="ORD-2026-99999"), reading(3, order=None), reading(4, value=141)])
    lost = c.referential_check({"readings": rows}, orders(spark, [order(), order("B", "MAT-77")]), materials(spark)).collect()
    assert {(r.source, r.missing_id, r.n_rows) for r in lost} == {("readings", "ORD-2026-99999", 1), ("orders", "MAT-77", 1)}
    out = c.range_check(readings(spark, [reading(1, value=20), reading(2, value=140), reading(3, value=140.5), reading(4, value=19)]))
    assert {r.reading_id for r in out.collect()} == {"r000003", "r000004"}


def test_parse_readings(spark):
    def text(**change):
        return json.dumps({**GOOD["C1"], **change})

    missing = copy.deepcopy(GOOD["C1"])
    del missing["unit"], missing["plant"]
    no_order = copy.deepcopy(GOOD["C1"])
    del no_order["order_id"]
    cases = [
        (text(), None), (text(value="1.5"), None), (text(value="abc"), "value is not a finite number"),
        (text(value=True), "value is not a finite number"), (text(value=None), "value is not a finite number"),
        (text(value="inf"), "value is not a finite number"), (text(value="NaN"), "value is not a finite number"),
        ('{"value": NaN}', "not valid JSON"), ("no", "not valid JSON"), ("[]", "not a JSON object"),
        (json.dumps(missing), "missing fields: plant, unit"), (json.dumps(no_order), None), (text(_meta=1), None),
        (text(timestamp_opc="later"), "unreadable timestamp"), (text(timestamp_opc="2031-11-19T06:17:50+02:00"), None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "n int, raw_payload string")
    parsed = m.parse_readings(df).orderBy("n").collect()
    assert [r.reject_reason for r in parsed] == [reason for _, reason in cases]
    assert parsed[1].value == 1.5 and str(parsed[-1].timestamp_opc) == "2031-11-19 04:17:50"
    assert m.accepted(m.parse_readings(df)).count() + m.rejected(m.parse_readings(df)).count() == len(cases)


def test_topics(spark):
    rows = [("factory/regensburg/oven-01/moisture", "regensburg", "oven-01", "moisture"),
            ("factory/regensburg/oven-01/vacuum", "regensburg", "oven-01", "moisture"), ("factory/x", "x", "", "")]
    df = spark.createDataFrame(rows, "topic string, plant string, oven_id string, sensor_type string")
    found = m.split_topic(df).collect()
    assert [r.topic_agrees for r in found] == [True, False, False]
    assert found[0].topic_sensor_type == "moisture" and found[2].topic_plant is None


def test_event_ingest(spark):
    good, bad = json.dumps(GOOD["C10"]), json.dumps({**GOOD["C10"], "payload": None})
    stored, refused = m.ingest_cycle_events(spark.createDataFrame([(good,), (bad,)], "raw_payload string"))
    row = stored.first()
    assert stored.count() == 1 and row.raw_payload == good and row.event_type == "cycle_started"
    assert refused.first().errors == ["payload: required for cycle_started"]


def test_types_are_told_without_schemas_of_whole_texts(spark):
    """Whether a text, a list element or a payload is an object or a list needs no schema of what is inside."""
    texts = [None, "", "{", "null", "7", "[]", "{}", '[{"a": 1}]', '{"readings": null}', '{"readings": {}}', '{"readings": [1, null, [], {}]}',
             '{"event_type": "cycle_aborted", "payload": null}', '{"event_type": "cycle_aborted", "payload": []}',
             '{"event_type": "cycle_aborted", "payload": 3}', '{"event_type": "cycle_aborted", "payload": {}}']
    df = spark.createDataFrame(list(enumerate(texts)), "n int, raw_payload string").repartition(2)
    unread, other = ["payload: not valid JSON"], ["payload: must be object"]
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        found = {}
        for contract in ("C3", "C10"):
            checked = c.VALIDATORS[contract](df)
            assert "schema_of_variant(_v#" not in checked._jdf.queryExecution().analyzed().toString()
            found[contract] = {r.n: r.errors for r in checked.collect()}
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    for errors in found.values():
        assert [errors[n] for n in (0, 1, 2)] == [unread] * 3 and [errors[n] for n in (3, 4, 5, 7)] == [other] * 4
    lists = [[e for e in found["C3"][n] if e.startswith("readings")] for n in (6, 8, 9, 10)]
    assert lists[:3] == [["readings: must be array"]] * 3
    assert [e for e in lists[3] if "must be object" in e] == [f"readings[{i}]: must be object" for i in (0, 1, 2)]
    assert len(lists[3]) == 9 and all(e.startswith("readings[3].") for e in lists[3][3:])
    payloads = [[e for e in found["C10"][n] if e.startswith("payload")] for n in (11, 12, 13, 14)]
    assert payloads == [["payload: required for cycle_aborted"], ["payload: must be object"], ["payload: must be object"],
                        ["payload.reason: required"]]
