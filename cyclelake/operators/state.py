"""Historian and oven state: latest values, ring buffers, cycle edges and runs, status per oven.

Everything works on event time, ties broken by (timestamp_mqtt, reading_id), with an explicit ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelake.functions.ordered import OrderedSeries, as_of_value, first_n_per_key, last_n_per_key
from cyclelake.functions.joins import PROBE, hot_keys, join_dimension, join_per_key
from cyclelake.functions.timing import as_of_column, minutes_between
from cyclelake.schemas import SENSOR_TYPES, WARMING_MINUTES
from cyclelake.session import shared_dir

CHANNEL = ["oven_id", "sensor_type"]
ARRIVAL = ["timestamp_opc", "timestamp_mqtt", "reading_id"]
STATE_COLUMN = {"temperature": "temperature_degC", "vacuum": "vacuum_mbar", "moisture": "moisture_ppm"}


def _good(readings: DataFrame, good_only: bool) -> DataFrame:
    return readings.filter(F.col("quality") == "Good") if good_only else readings


def latest_per_channel(readings: DataFrame, good_only: bool = False) -> DataFrame:
    """Newest reading per (oven, sensor), all columns."""
    rest = [c for c in readings.columns if c not in CHANNEL]
    newest = F.max_by(F.struct(*rest), F.struct(*ARRIVAL)).alias("_r")
    return _good(readings, good_only).groupBy(*CHANNEL).agg(newest).select(*CHANNEL, "_r.*")


def retain_last_n(readings: DataFrame, n: int = 500, slice_minutes: int = 60) -> DataFrame:
    """The newest n readings per (oven, sensor)."""
    return last_n_per_key(readings, CHANNEL, ARRIVAL, n, slice_minutes)


def historian_query(
    readings: DataFrame, order_id: str, oven_id: str | None = None, sensor_type: str | None = None,
    from_ts=None, to_ts=None, limit: int = 1000,
) -> DataFrame:
    """Readings of one order in time order, inclusive bounds, the oldest ``limit`` rows."""
    if not 1 <= limit <= 10000:
        raise ValueError("limit must be between 1 and 10000")
    rows = readings.filter(F.col("order_id") == order_id)
    if oven_id:
        rows = rows.filter(F.col("oven_id") == oven_id)
    if sensor_type:
        rows = rows.filter(F.col("sensor_type") == sensor_type)
    if from_ts is not None:
        rows = rows.filter(F.col("timestamp_opc") >= F.lit(from_ts).cast("timestamp"))
    if to_ts is not None:
        rows = rows.filter(F.col("timestamp_opc") <= F.lit(to_ts).cast("timestamp"))
    return rows.orderBy("timestamp_opc", "reading_id").limit(limit)


def historian_response(readings: DataFrame, limit: int = 1000) -> DataFrame:
    """Per order the historian answer: count and the array of the oldest ``limit`` readings. The limit is
    applied before the rows are collected, so an array never grows with the series."""
    if not 1 <= limit <= 10000:
        raise ValueError("limit must be between 1 and 10000")
    known = readings.filter(F.col("order_id").isNotNull())
    oldest = first_n_per_key(known, ["order_id"], ["timestamp_opc", "reading_id"], limit)
    item = F.struct("timestamp_opc", "reading_id", "sensor_type", "value", "unit", "quality")
    answer = oldest.groupBy("order_id").agg(F.array_sort(F.collect_list(item)).alias("_items"))
    shaped = F.transform(
        "_items",
        lambda r: F.struct(
            r.reading_id.alias("reading_id"), r.timestamp_opc.alias("timestamp_opc"),
            r.sensor_type.alias("sensor_type"), r.value.alias("value"), r.unit.alias("unit"),
            r.quality.alias("quality"),
        ),
    )
    return answer.select("order_id", F.size("_items").alias("count"), shaped.alias("readings"))


def active_order(readings: DataFrame) -> DataFrame:
    """order_id of the newest reading per oven; null means idle."""
    newest = F.max_by(F.struct("order_id"), F.struct(*ARRIVAL)).alias("_r")
    return readings.groupBy("oven_id").agg(newest).select("oven_id", "_r.order_id")


def cycle_edges(readings: DataFrame, restart_on_change: bool = False, slice_minutes: int = 60) -> DataFrame:
    """Readings where an order appears on an idle oven (start) or disappears (end). A direct change from one
    order to another is no edge unless ``restart_on_change``."""
    rows = readings.select("oven_id", "order_id", *ARRIVAL)
    series = OrderedSeries(rows, ["oven_id"], ARRIVAL, slice_minutes).with_previous(previous_order="order_id")
    before, now = F.col("previous_order"), F.col("order_id")
    started = before.isNull() & now.isNotNull()
    if restart_on_change:
        started = now.isNotNull() & ~before.eqNullSafe(now)
    edge = F.when(started, "start").when(before.isNotNull() & now.isNull(), "end")
    return series.withColumn("edge", edge).filter(F.col("edge").isNotNull())


def cycle_runs(readings: DataFrame, restart_on_change: bool = False, slice_minutes: int = 60) -> DataFrame:
    """Uninterrupted stretches with an active order per oven: number, start, end, orders, readings."""
    rows = readings.select("oven_id", "order_id", *ARRIVAL)
    if restart_on_change:
        rows = OrderedSeries(rows, ["oven_id"], ARRIVAL, slice_minutes).with_previous(_before="order_id")
        opens = ~F.col("_before").eqNullSafe(F.col("order_id"))
    else:
        opens = F.col("order_id").isNull()
    mark = F.when(opens, F.struct(*ARRIVAL))
    marked = OrderedSeries(rows, ["oven_id"], ARRIVAL, slice_minutes).with_last_seen(_run=mark)
    runs = marked.filter(F.col("order_id").isNotNull()).groupBy("oven_id", "_run").agg(
        F.min("timestamp_opc").alias("run_start"),
        F.max("timestamp_opc").alias("run_end"),
        F.countDistinct("order_id").alias("n_orders"),
        F.count(F.lit(1)).alias("n_readings"),
    )
    numbered = OrderedSeries(runs, ["oven_id"], ["run_start", "run_end", "_run"], slice_minutes * 24)
    return numbered.with_row_number("run_number").drop("_run")


def _current(readings: DataFrame, restart_on_change: bool) -> DataFrame:
    """One row per oven: newest order, newest value per sensor, last reading time and start of the running
    cycle. Two grouped passes with map-side combine (three with ``restart_on_change``); no ordered window, and no reading is
    shuffled: what is known of the ovens after a pass comes to the readings."""
    position = F.struct(*ARRIVAL)
    shared_dir(readings.sparkSession)
    newest = readings.groupBy("oven_id").agg(
        F.max_by(F.struct("order_id"), position).alias("_order"),
        F.max("timestamp_opc").alias("last_seen"),
        F.max(F.when(F.col("order_id").isNull(), position)).alias("_idle"),
        *[
            F.max_by("value", F.when(F.col("sensor_type") == s, position)).alias(STATE_COLUMN[s])
            for s in SENSOR_TYPES
        ],
    ).withColumn("order_id", F.col("_order.order_id")).drop("_order").checkpoint()
    rows = readings.select("oven_id", F.col("order_id").alias("_row_order"), *ARRIVAL)
    marks = newest.select("oven_id", "order_id", "_idle")
    if restart_on_change:
        other = join_dimension(rows, marks.drop("_idle"), "oven_id").filter(~F.col("_row_order").eqNullSafe(F.col("order_id")))
        marks = marks.drop("_idle").join(other.groupBy("oven_id").agg(F.max(position).alias("_idle")), "oven_id", "left")
    running = join_dimension(rows, marks.filter(F.col("order_id").isNotNull()), "oven_id").filter(
        F.col("_idle").isNull() | (position > F.col("_idle")))
    start = running.groupBy("oven_id").agg(F.min("timestamp_opc").alias("cycle_start"))
    return newest.drop("_idle").join(start, "oven_id", "left")


def elapsed_minutes(start="cycle_start", as_of=None) -> Column:
    """Minutes of the running cycle with two decimals; null when idle."""
    return F.round(minutes_between(start, as_of_column(as_of)), 2)


def cycle_elapsed_minutes(readings: DataFrame, as_of=None, restart_on_change: bool = False) -> DataFrame:
    current = _current(readings, restart_on_change)
    return current.select("oven_id", "order_id", elapsed_minutes(as_of=as_of).alias("cycle_elapsed_minutes"))


def threshold_met(moisture, threshold) -> Column:
    """Latest moisture strictly below the threshold; null without a moisture reading."""
    return F.col(moisture) < threshold


def moisture_threshold_met(readings: DataFrame, threshold: float = 500.0) -> DataFrame:
    latest = F.max_by("value", F.when(F.col("sensor_type") == "moisture", F.struct(*ARRIVAL)))
    moisture = readings.groupBy("oven_id").agg(latest.alias("moisture_ppm"))
    return moisture.withColumn("moisture_threshold_met", threshold_met("moisture_ppm", F.lit(threshold)))


def status_column(threshold: Column, max_minutes: Column) -> Column:
    """idle, then timeout (elapsed >= maximum), then cycle_complete (moisture < threshold), else running."""
    return (
        F.when(F.col("order_id").isNull(), "idle")
        .when(F.col("cycle_elapsed_minutes") >= max_minutes, "timeout")
        .when(F.col("moisture_ppm") < threshold, "cycle_complete")
        .otherwise("running")
    )


def with_status(current: DataFrame, threshold: Column, max_minutes: Column, as_of=None) -> DataFrame:
    """Status, elapsed time and threshold flag from the current values of an oven."""
    stamp = as_of_column(as_of)
    state = current.withColumn("cycle_elapsed_minutes", elapsed_minutes(as_of=stamp))
    state = state.withColumn("status", status_column(threshold, max_minutes))
    return state.select(
        "oven_id", "order_id", "status",
        *[F.round(c, 2).alias(c) for c in STATE_COLUMN.values()],
        "cycle_elapsed_minutes",
        threshold_met("moisture_ppm", threshold).alias("moisture_threshold_met"),
        stamp.alias("timestamp"),
    )


def oven_status(readings: DataFrame, threshold=500.0, max_minutes=600.0, as_of=None) -> DataFrame:
    return process_state(readings, threshold, max_minutes, as_of).select("oven_id", "status")


def process_state(
    readings: DataFrame, threshold: float = 500.0, max_minutes: float = 600.0, as_of=None,
    ovens: DataFrame | None = None, good_only: bool = False, restart_on_change: bool = False,
) -> DataFrame:
    """One row per oven: latest values, order, status, elapsed minutes, flag. Ovens asked for without data
    come back idle."""
    current = _current(_good(readings, good_only), restart_on_change)
    if ovens is not None:
        current = ovens.select("oven_id").distinct().join(current, "oven_id", "left")
    return with_status(current, F.lit(threshold), F.lit(max_minutes), as_of)


def process_state_per_material(
    readings: DataFrame, orders: DataFrame, materials: DataFrame, as_of=None, restart_on_change: bool = True,
    threshold: float = 500.0, max_minutes: float = 600.0,
) -> DataFrame:
    """Like process_state with target moisture and maximum duration of the material on the oven."""
    limits = orders.select("order_id", "material_id").join(
        materials.select("material_id", "target_moisture_ppm", "max_cycle_minutes"), "material_id"
    )
    current = _current(readings, restart_on_change).join(limits, "order_id", "left")
    return with_status(
        current, F.coalesce("target_moisture_ppm", F.lit(threshold)),
        F.coalesce("max_cycle_minutes", F.lit(max_minutes)), as_of,
    )


def known_ovens(readings: DataFrame) -> DataFrame:
    return readings.select("oven_id").distinct()


def sensor_fault(readings: DataFrame, seconds: float = 30, slice_minutes: int = 60) -> DataFrame:
    """Stretches of consecutive Bad readings of a channel that last longer than ``seconds``."""
    rows = readings.select(*CHANNEL, "quality", *ARRIVAL)
    mark = F.when(F.col("quality") != "Bad", F.struct(*ARRIVAL))
    marked = OrderedSeries(rows, CHANNEL, ARRIVAL, slice_minutes).with_last_seen(_since=mark)
    faults = marked.filter(F.col("quality") == "Bad").groupBy(*CHANNEL, "_since").agg(
        F.min("timestamp_opc").alias("fault_start"),
        F.max("timestamp_opc").alias("fault_end"),
        F.count(F.lit(1)).alias("n_bad"),
    )
    lasting = F.unix_micros("fault_end") - F.unix_micros("fault_start") > int(seconds * 1e6)
    return faults.filter(lasting).drop("_since")


def asof_order_stamp(readings: DataFrame, events: DataFrame, slice_minutes: int = 60) -> DataFrame:
    """Readings stamped with the order that was active on their oven: set by cycle_started, cleared by
    cycle_confirmed and cycle_aborted."""
    switches = events.filter(F.col("event_type").isin("cycle_started", "cycle_confirmed", "cycle_aborted"))
    order = F.when(F.col("event_type") == "cycle_started", F.col("order_id"))
    return as_of_value(
        readings.drop("order_id"), switches, ["oven_id"], ("timestamp_opc", "reading_id"),
        ("event_time", "event_id"), order, "order_id", width=slice_minutes,
    )


def cycle_phase(
    readings: DataFrame, pairs: DataFrame, orders: DataFrame, materials: DataFrame,
    warming_minutes: float = WARMING_MINUTES, hot=PROBE,
) -> DataFrame:
    """Readings tagged idle, warming, drying or complete from the minutes since cycle start and the first
    moisture at or below target after warming. ``hot``: heavy order ids where known, see join_per_key."""
    cycles = pairs.select("order_id", "cycle_start_time").join(
        orders.select("order_id", "material_id"), "order_id"
    ).join(materials.select("material_id", "target_moisture_ppm"), "material_id").drop("material_id")
    hot = hot_keys(readings, "order_id") if isinstance(hot, str) else hot
    rows = join_per_key(readings, cycles, "order_id", "left", hot=hot).withColumn(
        "elapsed_minutes", minutes_between("cycle_start_time", "timestamp_opc")
    )
    dry = (F.col("sensor_type") == "moisture") & (F.col("value") <= F.col("target_moisture_ppm"))
    hit = rows.filter(dry & (F.col("elapsed_minutes") > warming_minutes)).groupBy("order_id").agg(
        F.min("timestamp_opc").alias("_dry_at")
    )
    elapsed = F.col("elapsed_minutes")
    phase = (
        F.when(elapsed.isNull() | (elapsed <= 0), "idle")
        .when(elapsed <= warming_minutes, "warming")
        .when(F.col("timestamp_opc") >= F.col("_dry_at"), "complete")
        .otherwise("drying")
    )
    tagged = join_per_key(rows, hit, "order_id", "left", hot=hot).withColumn("phase", phase)
    return tagged.select(*readings.columns, "elapsed_minutes", "phase")
