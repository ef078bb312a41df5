"""The dashboard's questions over Gold and the Silver series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cyclelake.functions.joins import PROBE, join_per_key
from cyclelake.functions.timing import as_of_column, minutes_between
from cyclelake.operators.gold import v_cycle_efficiency, v_recent_cycles
from cyclelake.schemas import SENSOR_TYPES

OUTCOMES = ["all", "spec met", "over standard", "spec failed"]
DEFAULT_DAYS = 90


def filter_cycles(
    gold: DataFrame, date_from=None, date_to=None, materials=(), plants=(), outcome: str = "all", as_of=None,
) -> DataFrame:
    """Sidebar filters: cycles that ended in the range (default the 90 days before as_of), of the given
    materials and plants (empty means all) and of one outcome."""
    if outcome not in OUTCOMES:
        raise ValueError(f"unknown outcome {outcome!r}")
    end = F.lit(date_to).cast("timestamp") if date_to is not None else as_of_column(as_of)
    if date_from is not None:
        start = F.lit(date_from).cast("timestamp")
    else:
        start = end - F.make_dt_interval(F.lit(DEFAULT_DAYS))
    rows = gold.filter(F.col("cycle_end_time").between(start, end))
    if materials:
        rows = rows.filter(F.col("material_id").isin(*materials))
    if plants:
        rows = rows.filter(F.col("plant").isin(*plants))
    if outcome == "spec met":
        rows = rows.filter("spec_met")
    elif outcome == "over standard":
        rows = rows.filter("delta_minutes > 0")
    elif outcome == "spec failed":
        rows = rows.filter("not spec_met")
    return rows


def filter_options(gold: DataFrame) -> DataFrame:
    """Materials and plants present in Gold, as (kind, value, label)."""
    pairs = gold.groupBy("material_id", "plant").agg(F.max("material_description").alias("label"))
    materials = pairs.groupBy("material_id").agg(F.max("label").alias("label")).select(
        F.lit("material").alias("kind"), F.col("material_id").alias("value"), "label"
    )
    plants = pairs.select(F.lit("plant").alias("kind"), F.col("plant").alias("value"), F.col("plant").alias("label"))
    return materials.unionByName(plants.distinct())


def colour() -> Column:
    """Red without spec or more than 10 % over standard, amber over standard, else green."""
    over = F.col("delta_minutes")
    return (
        F.when(~F.coalesce("spec_met", F.lit(False)) | (over > 0.1 * F.col("standard_cycle_minutes")), "red")
        .when(over > 0, "amber")
        .otherwise("green")
    )


def cycle_overview(gold: DataFrame, n: int = 20) -> DataFrame:
    return v_recent_cycles(gold, n).select(
        "order_id", "material_description", "plant", "actual_duration_minutes", "standard_cycle_minutes",
        "delta_minutes", "spec_met", "cycle_end_time", colour().alias("colour"),
    )


def cycle_kpis(gold: DataFrame) -> DataFrame:
    """Per cycle the four cards: duration against standard, peak temperature, moisture against target, spec."""
    return gold.select(
        "order_id", "actual_duration_minutes", "standard_cycle_minutes", "delta_minutes",
        (F.lit(100.0) * F.col("delta_minutes") / F.col("standard_cycle_minutes")).alias("delta_pct"),
        "peak_temperature_degC", "final_moisture_ppm", "target_moisture_ppm",
        (F.col("final_moisture_ppm") - F.col("target_moisture_ppm")).alias("moisture_margin_ppm"), "spec_met",
    )


def cycle_series(gold: DataFrame, readings: DataFrame, hot=PROBE) -> DataFrame:
    """Wide series per cycle: one row per instant with the three sensors, elapsed minutes and target lines. ``hot``
    here and below: heavy order ids where known, see join_per_key."""
    lines = ["cycle_start_time", "target_moisture_ppm", "standard_cycle_minutes"]
    rows = join_per_key(readings, gold.select("order_id", *lines), "order_id", hot=hot)
    wide = rows.groupBy("order_id", "timestamp_opc", *lines).pivot("sensor_type", SENSOR_TYPES).agg(F.max("value"))
    return wide.select(
        "order_id", "timestamp_opc", minutes_between("cycle_start_time", "timestamp_opc").alias("elapsed_minutes"),
        *SENSOR_TYPES, "target_moisture_ppm", "standard_cycle_minutes",
    )


def threshold_crossing(gold: DataFrame, readings: DataFrame, hot=PROBE) -> DataFrame:
    """First reading of each cycle with moisture below target, between start and end."""
    cycles = gold.select("order_id", "cycle_start_time", "cycle_end_time", "target_moisture_ppm")
    moisture = readings.filter(F.col("sensor_type") == "moisture").select(
        "order_id", "reading_id", "timestamp_opc", "value"
    )
    below = F.col("value") < F.col("target_moisture_ppm")
    inside = F.col("timestamp_opc").between(F.col("cycle_start_time"), F.col("cycle_end_time"))
    first = join_per_key(moisture, cycles, "order_id", hot=hot).filter(below & inside).groupBy("order_id").agg(
        F.min("timestamp_opc").alias("crossed_at"), F.min("cycle_start_time").alias("_start")
    )
    return first.select(
        "order_id", "crossed_at", minutes_between("_start", "crossed_at").alias("crossed_after_minutes")
    )


def duration_by_material(gold: DataFrame) -> DataFrame:
    """Average duration against standard per material, green when not over standard."""
    means = gold.groupBy("material_id").agg(
        F.max("material_description").alias("material_description"),
        F.avg("actual_duration_minutes").alias("avg_actual_minutes"),
        F.avg("standard_cycle_minutes").alias("avg_standard_minutes"),
    )
    over = F.col("avg_actual_minutes") > F.col("avg_standard_minutes")
    return means.withColumn("colour", F.when(over, "over").otherwise("green"))


def moisture_vs_duration(gold: DataFrame) -> DataFrame:
    """One point per cycle."""
    return gold.select(
        "order_id", "material_id", "actual_duration_minutes", "final_moisture_ppm", "target_moisture_ppm", "spec_met",
        F.when(F.col("spec_met"), "circle").otherwise("cross").alias("symbol"),
    )


def efficiency_summary(gold: DataFrame) -> DataFrame:
    return v_cycle_efficiency(gold).select(
        "material_description", "material_id", F.col("total_cycles").alias("cycle_count"), "avg_delta_minutes",
        "pct_spec_met", F.col("avg_final_moisture_ppm").alias("avg_final_moisture"),
    )


def long_runners(gold: DataFrame) -> DataFrame:
    """Materials ranked by the share of cycles over standard, then by average delta. The rank runs over one
    row per material."""
    share = F.count_if(F.col("delta_minutes") > 0) / F.count(F.lit(1))
    means = gold.groupBy("material_id").agg(
        F.count(F.lit(1)).alias("n_cycles"), share.alias("share_over"), F.avg("delta_minutes").alias("avg_delta_minutes")
    )
    order = W.orderBy(F.desc("share_over"), F.desc("avg_delta_minutes"))
    return means.withColumn("position", F.rank().over(order).cast("bigint"))


def efficiency_trend(gold: DataFrame, period: str = "week", k: int = 4) -> DataFrame:
    """Per period and material: cycles, average delta, share in spec, and the mean of the last k periods'
    average delta. The window runs over one row per period."""
    rows = gold.groupBy(F.date_trunc(period, "cycle_end_time").alias("period"), "material_id").agg(
        F.count(F.lit(1)).alias("n_cycles"), F.avg("delta_minutes").alias("avg_delta_minutes"),
        (F.lit(100.0) * F.count_if("spec_met") / F.count(F.lit(1))).alias("pct_spec_met"),
    )
    last = W.partitionBy("material_id").orderBy("period").rowsBetween(-(k - 1), W.currentRow)
    return rows.withColumn("moving_avg_delta", F.avg("avg_delta_minutes").over(last))


def drying_waste(gold: DataFrame, readings: DataFrame, by=("order_id",), hot=PROBE) -> DataFrame:
    """Minutes between the moment moisture fell below target and the end of the cycle, and their share of the
    duration, per cycle or per group of cycles (material_id, plant)."""
    crossed = threshold_crossing(gold, readings, hot).select("order_id", "crossed_at")
    cycles = gold.join(crossed, "order_id").withColumn(
        "waste_minutes", minutes_between("crossed_at", "cycle_end_time")
    )
    return cycles.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_cycles"), F.sum("waste_minutes").alias("waste_minutes"),
        F.sum("actual_duration_minutes").alias("duration_minutes"),
        (F.sum("waste_minutes") / F.sum("actual_duration_minutes")).alias("waste_share"),
    )


def punctuality() -> Column:
    """early up to -10 % of standard, on time within 5 %, overrun from +10 %, else in between."""
    share = F.col("delta_minutes") / F.col("standard_cycle_minutes")
    return (
        F.when(share <= -0.1, "early").when(F.abs(share) <= 0.05, "on time").when(share >= 0.1, "overrun")
        .otherwise("between")
    )


def early_ontime_late(gold: DataFrame) -> DataFrame:
    classed = gold.withColumn("punctuality", punctuality())
    return classed.groupBy("material_id", "punctuality").agg(F.count(F.lit(1)).alias("n_cycles"))
