"""Silver to Gold: one row per completed cycle, and the views over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelake.functions.joins import PROBE, join_dimension, join_per_key
from cyclelake.functions.timing import minutes_between
from cyclelake.operators import silver as s

GOLD_COLUMNS = [
    "order_id", "material_id", "material_description", "plant", "oven_id", "cycle_start_time", "cycle_end_time",
    "actual_duration_minutes", "standard_cycle_minutes", "delta_minutes", "peak_temperature_degC",
    "min_vacuum_mbar", "final_moisture_ppm", "avg_moisture_ppm", "target_moisture_ppm", "spec_met",
    "temperature_limit_met", "quality_check_passed", "operator_id", "sap_confirmation_number",
    "goods_movement_posted",
]


def cycle_sensor_stats(readings: DataFrame, pairs: DataFrame | None = None, hot=PROBE) -> DataFrame:
    """Per order: highest temperature, lowest vacuum, last and average moisture, in one grouped pass. With
    ``pairs`` only readings between the start and the end of the cycle count. ``hot``: heavy order ids where known, see
    join_per_key."""
    rows = readings.filter(F.col("order_id").isNotNull())
    if pairs is not None:
        bounds = pairs.select("order_id", "cycle_start_time", "cycle_end_time")
        inside = F.col("timestamp_opc").between(F.col("cycle_start_time"), F.col("cycle_end_time"))
        rows = join_per_key(rows, bounds, "order_id", hot=hot).filter(inside)
    value, sensor = F.col("value"), F.col("sensor_type")
    moisture = sensor == "moisture"
    return rows.groupBy("order_id").agg(
        F.max(F.when(sensor == "temperature", value)).alias("peak_temperature_degC"),
        F.min(F.when(sensor == "vacuum", value)).alias("min_vacuum_mbar"),
        F.max_by(value, F.when(moisture, F.struct("timestamp_opc", "reading_id"))).alias("final_moisture_ppm"),
        F.avg(F.when(moisture, value)).alias("avg_moisture_ppm"),
    )


def with_durations(cycles: DataFrame) -> DataFrame:
    """Actual duration and its difference from standard (negative means faster)."""
    df = cycles.withColumn("actual_duration_minutes", minutes_between("cycle_start_time", "cycle_end_time"))
    return df.withColumn("delta_minutes", F.col("actual_duration_minutes") - F.col("standard_cycle_minutes"))


def with_spec_met(cycles: DataFrame) -> DataFrame:
    """Strictly below target; null without a moisture reading."""
    return cycles.withColumn("spec_met", F.col("final_moisture_ppm") < F.col("target_moisture_ppm"))


def with_temperature_limit(cycles: DataFrame, tolerance: float = 0.0) -> DataFrame:
    limit = F.col("target_temperature_degC") + F.lit(tolerance)
    return cycles.withColumn("temperature_limit_met", F.col("peak_temperature_degC") <= limit)


def gold_cycle_summary(
    pairs: DataFrame, orders: DataFrame, materials: DataFrame, readings: DataFrame,
    order_state: DataFrame | None = None, tolerance: float = 0.0, bounded: bool = False,
) -> DataFrame:
    """One row per order with both a start and a confirmation that does not precede it. The grouped inputs and
    the orders are all distributed by order_id, so the joins add no shuffle; materials are counted and broadcast."""
    complete = complete_pairs(pairs)
    stats = cycle_sensor_stats(readings, complete if bounded else None)
    return summarise(complete, orders, materials, stats, order_state, tolerance)


def complete_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("cycle_end_time") >= F.col("cycle_start_time"))


def summarise(
    complete: DataFrame, orders: DataFrame, materials: DataFrame, stats: DataFrame, order_state: DataFrame | None = None,
    tolerance: float = 0.0,
) -> DataFrame:
    """Gold rows of complete cycles from their sensor statistics (one row per order)."""
    order = orders.select(
        "order_id", "material_id", "plant", "oven_id", F.col("operator_id").alias("_order_operator"),
        F.col("sap_confirmation_number").alias("_order_confirmation"), "goods_movement_posted",
    )
    material = materials.select(
        "material_id", "material_description", "standard_cycle_minutes", "target_moisture_ppm",
        "target_temperature_degC",
    )
    joined = complete.join(order, "order_id").join(stats, "order_id", "left")
    if order_state is None:
        joined = joined.withColumn("quality_check_passed", F.lit(None).cast("boolean"))
    else:
        joined = joined.join(order_state.select("order_id", "quality_check_passed"), "order_id", "left")
    joined = join_dimension(joined, material, "material_id", spread_by="order_id").withColumns({
        "operator_id": F.coalesce("operator_id", "_order_operator"),
        "sap_confirmation_number": F.coalesce("sap_confirmation_number", "_order_confirmation"),
    })
    return with_temperature_limit(with_spec_met(with_durations(joined)), tolerance).select(*GOLD_COLUMNS)


def gold_from_bronze(
    events: DataFrame, orders: DataFrame, materials: DataFrame, readings: DataFrame,
    order_state: DataFrame | None = None, tolerance: float = 0.0, bounded: bool = False,
) -> DataFrame:
    """Gold straight from the Bronze tables: the Silver steps and the cycle summary in one plan."""
    pairs = s.cycle_pairs(s.silver_cycle_events(events))
    return gold_cycle_summary(
        pairs, s.silver_orders(orders), s.silver_materials(materials), s.silver_readings(readings), order_state,
        tolerance, bounded,
    )


def v_cycle_efficiency(gold: DataFrame) -> DataFrame:
    """Per material: number of cycles, average durations and delta, faster cycles, cycles in spec."""
    return gold.groupBy("material_id").agg(
        F.max("material_description").alias("material_description"),
        F.count(F.lit(1)).alias("total_cycles"),
        F.avg("actual_duration_minutes").alias("avg_actual_minutes"),
        F.avg("standard_cycle_minutes").alias("avg_standard_minutes"),
        F.avg("delta_minutes").alias("avg_delta_minutes"),
        F.count_if(F.col("delta_minutes") < 0).alias("cycles_faster_than_standard"),
        F.count_if("spec_met").alias("cycles_meeting_moisture_spec"),
        F.avg("final_moisture_ppm").alias("avg_final_moisture_ppm"),
        (F.lit(100.0) * F.count_if("spec_met") / F.count(F.lit(1))).alias("pct_spec_met"),
    )


def v_recent_cycles(gold: DataFrame, n: int = 20, by: str = "cycle_end_time") -> DataFrame:
    """The last n cycles, newest first."""
    return gold.orderBy(F.desc(by), "order_id").limit(n)


def cycle_detail(gold: DataFrame, readings: DataFrame, order_ids: DataFrame, hot=PROBE) -> tuple[DataFrame, DataFrame]:
    """The Gold rows of the asked orders and their readings."""
    keys = order_ids.select("order_id").distinct()
    return gold.join(keys, "order_id", "left_semi"), join_per_key(readings, keys, "order_id", "left_semi", hot=hot)


def touched_orders(*changes: DataFrame) -> DataFrame:
    """Order ids named by new events, readings or order versions."""
    keys = changes[0].select("order_id")
    for change in changes[1:]:
        keys = keys.unionByName(change.select("order_id"))
    return keys.filter(F.col("order_id").isNotNull()).distinct()


def gold_incremental(
    changed: DataFrame, pairs_source: DataFrame, orders: DataFrame, materials: DataFrame, readings: DataFrame,
    order_state: DataFrame | None = None, tolerance: float = 0.0, hot=PROBE,
) -> DataFrame:
    """Gold rows of the changed orders only; feed the result to ``upsert_latest``. ``pairs_source`` holds the
    Silver events."""
    keep = lambda df: df.join(changed, "order_id", "left_semi")
    series = join_per_key(readings, changed, "order_id", "left_semi", hot=hot)
    log = join_per_key(pairs_source, changed, "order_id", "left_semi", "event_id")
    state = keep(order_state) if order_state is not None else None
    return gold_cycle_summary(
        s.cycle_pairs(log), keep(orders), materials, series, state, tolerance
    )
