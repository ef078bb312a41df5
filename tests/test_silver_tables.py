"""Clustered Silver tables: Gold over them moves no reading, event or order."""

import pytest

from conftest import event, events, materials, order, orders, reading, readings
from cyclelake.operators import gold as g, silver as s
from cyclelake.sources import silver_tables as st


@pytest.mark.parametrize("hot", [False, True])
def test_gold_over_tables_has_no_exchange(spark, folder, hot):
    names = ["hot" if hot and i % 3 else f"o{i}" for i in range(30)]
    log = [event(2 * i, "cycle_started", n, i) for i, n in enumerate(names)] + [event(100 + i, "cycle_confirmed", n, 300 + i) for i, n in enumerate(names)]
    rows = [reading(i, ["moisture", "vacuum", "temperature"][i % 3], i, i, order=names[i % 30]) for i in range(300)]
    silver = {"readings": readings(spark, rows), "events": s.silver_cycle_events(events(spark, log)),
              "orders": s.silver_orders(orders(spark, [order(n) for n in set(names)]))}
    tables = st.write_silver(spark, f"{folder}/silver", f"t{int(hot)}", 4, **silver)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gold = st.gold_over_tables(spark, tables, materials(spark))
        plan = gold._jdf.queryExecution().executedPlan().toString()
        found = {tuple(r) for r in gold.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not "Exchange hashpartitioning(order_id" in plan and plan.count("Bucketed: true") == 3
    expected = g.gold_cycle_summary(s.cycle_pairs(silver["events"]), silver["orders"], materials(spark), silver["readings"])
    assert found == {tuple(r) for r in expected.collect()} and found


def test_buckets_grow_with_the_files_read(spark, folder):
    readings(spark, [reading(i, order=f"o{i}") for i in range(50)]).write.parquet(f"{folder}/bronze readings")
    bronze = spark.read.parquet(f"{folder}/bronze readings")
    size = st.input_megabytes(spark, bronze, bronze)
    assert size > 0 and st.input_megabytes(spark, bronze, bronze.filter("value > 0")) == size
    for share, buckets in ((10, 2), (0.2, 5)):
        names = st.write_silver(spark, f"{folder}/silver{buckets}", f"grown{buckets}", 2, share * size, readings=bronze)
        found = spark.sql(f"describe extended {names['readings']}").filter("col_name = 'Num Buckets'").first()
        assert int(found.data_type) == buckets and spark.table(names["readings"]).count() == 50
