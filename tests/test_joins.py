import pytest
from pyspark.sql import functions as F

from conftest import reading, readings
from cyclelake.functions import joins


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_hot_keys_give_the_plain_join(spark, how):
    rows = [reading(i, order="hot" if i % 3 else f"o{i % 50}", minutes=i) for i in range(600)]
    rows += [reading(900 + i, order="lost") for i in range(200)] + [reading(2000, order=None)]
    df = readings(spark, rows)
    table = spark.createDataFrame([("hot", 1, None), *[(f"o{i}", i, "x") for i in range(0, 50, 2)]],
                                  "order_id string, limit int, note string")
    columns = df.columns if how == "left_semi" else [*df.columns, "limit", "note"]
    hot = joins.hot_keys(df, "order_id", 100)
    assert {r[0] for r in hot.collect()} == {"hot", "lost"} and joins.hot_keys(df, "order_id", 1000) is None
    found = joins.join_per_key(df, table, "order_id", how, hot=hot).select(*columns)
    plain = df.join(table, "order_id", how).select(*columns)
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, found.collect())) == sorted(map(key, plain.collect()))


def test_hot_rows_are_spread(spark):
    df = readings(spark, [reading(i, order="hot" if i < 1000 else None) for i in range(2000)])
    table = spark.createDataFrame([("hot", 1)], "order_id string, limit int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = joins.hot_keys(df, "order_id", 100)
        joined = joins.join_per_key(df, table, "order_id", "left", hot=hot)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 2000 and len(sizes) == 4 and max(sizes) < 700


def test_operators_with_hot_orders(spark, monkeypatch):
    """The catalogue queries that join readings with orders, with every order treated as hot."""
    from oracle import compare, connect
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(joins, "HOT_ROWS", 2)
    db = connect(sf)
    for name in ("cycle_phase", "expected_profile", "threshold_crossing", "cycle_series", "cycle_detail",
                 "cycle_sensor_stats_bounded", "gold_incremental", "confirmation_audit"):
        ok, message = compare(spark, db, name, entry.queries()[name], entry.oracle_sql()[name], sf)
        assert ok, message


def test_small_tables_are_broadcast_and_large_ones_split(spark, monkeypatch):
    """Queries that meet ovens or materials, of which a few may hold all rows, in both ways."""
    from oracle import compare, connect
    import __spark_entry__ as entry

    sf, names = "/root/testdata/sf0.001", ["process_state", "process_state_per_material", "cycle_elapsed_minutes", "oven_status",
                                           "gold_cycle_summary", "orders_with_spec", "timeouts", "alert_temperature_spike", "alert_vacuum_loss"]
    plan = lambda name: entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin [oven_id" in plan("alert_vacuum_loss") and "BroadcastHashJoin [material_id" in plan("orders_with_spec")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(joins, "SMALL_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 2)
    db = connect(sf)
    for name in names:
        ok, message = compare(spark, db, name, entry.queries()[name], entry.oracle_sql()[name], sf)
        assert ok, (name, message)


def test_operators_with_long_keys(spark, monkeypatch):
    """The catalogue queries built on ordered scans, with every key cut into slices."""
    from cyclelake.functions import ordered
    from oracle import compare, connect
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    db = connect(sf)
    names = ["cycle_edges", "cycle_runs", "sensor_fault", "asof_order_stamp", "audit_transitions", "confirmation_audit",
             "document_numbers", "overlapping_cycles", "ewma", "alert_moisture_stalled", "alert_temperature_spike",
             "alert_vacuum_loss"]
    monkeypatch.setattr(ordered, "KEY_ROWS", 2)
    for name in names:
        ok, message = compare(spark, db, name, entry.queries()[name], entry.oracle_sql()[name], sf)
        assert ok, (name, message)
    monkeypatch.setattr(ordered, "MAX_SLICE_ROWS", 3)
    for name in ("cycle_runs", "asof_order_stamp", "alert_moisture_stalled"):
        ok, message = compare(spark, db, name, entry.queries()[name], entry.oracle_sql()[name], sf)
        assert ok, (name, message)
