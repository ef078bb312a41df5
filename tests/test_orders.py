import pytest
from pyspark.sql import functions as F

from conftest import MATERIALS, at, event, events, materials, order, orders
from cyclelake import schemas
from cyclelake.operators import orders as o

CONFIRMATION = schemas.CONFIRMATION.fieldNames() + ["posted_at", "sap_confirmation_number"]


def confirmations(spark, rows):
    """(order_id, minutes) pairs as confirmations."""
    data = [(x, f"{x}-OPR-010", 1.0, at(5), at(400), "OP-9", 287.4, True, at(m), f"CONF-2026-{i:05d}")
            for i, (x, m) in enumerate(rows)]
    schema = schemas.CONFIRMATION.jsonValue()
    df = spark.createDataFrame(data, ", ".join(
        [f"{f['name']} {f['type']}" for f in schema["fields"]] + ["posted_at timestamp", "sap_confirmation_number string"]))
    assert df.columns == CONFIRMATION
    return df


def test_list_orders(spark):
    df = orders(spark, [order("A"), order("B", status="CONFIRMED"), order("C", plant="kirchheim")])
    assert {r.order_id for r in o.list_orders(df, "released").collect()} == {"A", "C"}
    assert {r.order_id for r in o.list_orders(df, "RELEASED", "regensburg").collect()} == {"A"}
    assert o.list_orders(df).count() == 3
    with pytest.raises(ValueError):
        o.list_orders(df, "RUNNING")


def test_lookup(spark):
    keys = spark.createDataFrame([("A",), ("A",), ("Z",)], "order_id string")
    found, missing = o.lookup(keys, orders(spark, [order("A"), order("B")]), "order_id")
    assert [r.order_id for r in found.collect()] == ["A"] and [r.order_id for r in missing.collect()] == ["Z"]


def test_orders_with_spec(spark):
    rows = o.orders_with_spec(orders(spark, [order("A", "MAT-0003"), order("B", "MAT-9999")]), materials(spark)).collect()
    assert {(r.order_id, r.standard_cycle_minutes) for r in rows} == {("A", 120), ("B", None)}


@pytest.mark.parametrize("statuses, illegal", [
    (["CREATED", "RELEASED", "IN_PROGRESS", "CONFIRMED", "CLOSED"], []),
    (["CREATED", "CONFIRMED"], [("CREATED", "CONFIRMED")]),
    (["RELEASED", "ABORTED", "RELEASED"], [("ABORTED", "RELEASED")]),
    (["RELEASED", "CONFIRMED"], [("RELEASED", "CONFIRMED")]),
    (["CREATED", "CREATED"], [("CREATED", "CREATED")]),
])
def test_audit(spark, statuses, illegal):
    history = orders(spark, [order(status=x, updated=100000 * i) for i, x in enumerate(statuses)])
    found = o.audit_transitions(history.unionByName(history)).collect()
    assert [(r.from_status, r.to_status) for r in found] == illegal


def test_audit_of_the_shop_floor(spark):
    rows = [order(status=x, updated=i) for i, x in enumerate(["released", "in-progress", "closed"])]
    found = o.audit_transitions(orders(spark, rows), "shop_floor").collect()
    assert [(r.from_status, r.to_status) for r in found] == [("in-progress", "closed")]


def test_state_from_events(spark):
    log = [event(1, "cycle_started", "A", 1), event(2, "cycle_confirmed", "A", 9), event(3, "cycle_started", "B", 1),
           event(4, "cycle_timeout", "C", 5), event(5, "sap_confirmation_failed", "D", 5), event(6, "cycle_aborted", "C", 6)]
    found = {r.order_id: r.status for r in o.order_state_from_events(events(spark, log)).collect()}
    assert found == {"A": "closed", "B": "in-progress", "C": "ABORTED", "D": "CONFIRM_FAILED"}


def test_confirmation_outcomes(spark):
    history = orders(spark, [
        order("A", status="IN_PROGRESS", updated=1), order("B", status="CONFIRMED", updated=1),
        order("C", status="ABORTED", updated=1), order("D", status="RELEASED", updated=1),
        order("E", status="RELEASED", updated=500),
    ])
    asked = confirmations(spark, [("A", 400), ("A", 410), ("A", 420), ("B", 400), ("C", 400), ("D", 400), ("X", 400), ("E", 400)])
    audited = o.confirmation_audit(asked, history)
    found = sorted((r.order_id, r.outcome) for r in audited.collect())
    assert found == [
        ("A", "already_confirmed"), ("A", "already_confirmed"), ("A", "ok"), ("B", "already_confirmed"),
        ("C", "invalid_status"), ("D", "ok"), ("E", "invalid_status"), ("X", "not_found"),
    ]
    after = {r.order_id: r for r in o.apply_confirmations(history, audited).collect()}
    assert (after["A"].status, after["A"].operator_id, after["A"].actual_end) == ("CONFIRMED", "OP-9", at(400))
    assert after["A"].sap_confirmation_number == "CONF-2026-00000" and after["A"].updated_at == at(400)
    assert after["C"].status == "ABORTED" and after["C"].operator_id is None


def test_goods_movements(spark):
    rows = [("GR-2026-003901", "A", "MAT-0001", "GR_PRODUCTION", 1.0, "EA", at().date(), "WH-01", at())] * 2
    moved = spark.createDataFrame(rows, schemas.MOVEMENT)
    df = orders(spark, [order("A"), order("B", goods_movement_posted=True)])
    found = {r.order_id: r.goods_movement_posted for r in o.flag_goods_movement(df, moved).collect()}
    assert found == {"A": True, "B": False}
    assert o.movements_of(moved, df).count() == 2


def test_merge_keeps_local_status(spark):
    local = orders(spark, [order("A", status="in-progress")])
    erp = orders(spark, [order("A", status="CONFIRMED"), order("B", status="CREATED")])
    for _ in range(2):
        merged = o.merge_keep_local(local, erp)
        assert {(r.order_id, r.status) for r in merged.collect()} == {("A", "in-progress"), ("B", "released")}
        local = merged


def test_spec_at_confirmation(spark):
    rows = [(True, 200.0, 300), (True, 300.0, 300), (False, 200.0, 300), (True, 999.0, None)]
    df = spark.createDataFrame(rows, "quality_check_passed boolean, final_moisture_ppm double, target_moisture_ppm int")
    assert [r[0] for r in df.select(o.spec_met_at_confirmation()).collect()] == [True, False, False, True]


def test_timeouts_and_extensions(spark):
    df = orders(spark, [order("A", status="IN_PROGRESS", actual_start=at()), order("B", "MAT-0002", actual_start=at(), status="RELEASED"),
                        order("C", "MAT-0002", status="IN_PROGRESS", actual_start=at())])
    assert {(r.order_id, r.minutes_over) for r in o.timeouts(df, materials(spark), at(600)).collect()} == {("C", 300)}
    granted = spark.createDataFrame([("C", 200), ("C", 99)], "order_id string, extension_minutes int")
    assert [r.minutes_over for r in o.timeouts(df, materials(spark), at(600), granted).collect()] == [1]


def test_incomplete_cycles(spark):
    log = [event(1, "cycle_started", "A"), event(2, "cycle_confirmed", "B"), event(3, "cycle_started", "C", 9),
           event(4, "cycle_confirmed", "C", 5), event(5, "cycle_started", "D"), event(6, "cycle_aborted", "D", 9)]
    known = orders(spark, [order(x, status="CONFIRMED") for x in "ABCDE"])
    found = {r.order_id: r.reason for r in o.incomplete_cycles(events(spark, log), known).collect()}
    assert found == {"A": "started_without_end", "B": "confirmed_without_start", "C": "end_before_start",
                     "E": "confirmed_without_events"}


def test_document_numbers(spark):
    docs = ["CONF-2026-00901", "CONF-2026-00902", "CONF-2026-00902", "CONF-2026-00907", "CONF-2025-00001", "GR-2026-003901", "x"]
    df = spark.createDataFrame([(x,) for x in docs], "doc string")
    for width in (2, 100_000):
        found = {(r.kind, r.year, r.issue, r.first_number, r.last_number, r.n) for r in o.document_numbers(df, "doc", width).collect()}
        assert found == {("CONF", 2026, "gap", 903, 906, 4), ("CONF", 2026, "duplicate", 902, 902, 2)}


def test_overlaps(spark):
    rows = [("A", "oven-01", at(0), at(100)), ("B", "oven-01", at(10), at(20)), ("C", "oven-01", at(50), at(150)),
            ("D", "oven-01", at(150), None), ("E", "oven-01", at(99999), at(100000)), ("F", "oven-02", at(5), at(9))]
    df = spark.createDataFrame(rows, "order_id string, oven_id string, cycle_start_time timestamp, cycle_end_time timestamp")
    assert {r.order_id for r in o.overlapping_cycles(df).collect()} == {"B", "C", "E"}


def test_counts(spark):
    df = orders(spark, [order("A"), order("B"), order("C", MATERIALS[1][0], "CLOSED")])
    assert {(r.status, r.n_orders) for r in o.order_counts(df).collect()} == {("RELEASED", 2), ("CLOSED", 1)}
    assert o.order_counts(df, "material_id").agg(F.sum("n_orders")).first()[0] == 3
