"""Expected profiles, smoothing, alerts, cycle-end estimates, resampling and lags."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cyclelake.functions.joins import PROBE, join_dimension, join_per_key
from cyclelake.functions.ordered import OrderedSeries, as_of_value
from cyclelake.functions.timing import MICROS_PER_MINUTE, as_of_column, col, micros, minutes_between, slot_start
from cyclelake.operators.silver import first_per_key
from cyclelake.operators.state import cycle_phase
from cyclelake.schemas import (
    AMBIENT_TEMPERATURE, ATMOSPHERIC_PRESSURE, COMPRESSION_FACTOR, INITIAL_MOISTURE, SENSOR_NOISE, VACUUM_FLOOR,
    VACUUM_TAU_MINUTES, WARMING_MINUTES,
)

CYCLE_CHANNEL = ["order_id", "sensor_type"]
# A fitted slope closer to zero than this (per minute) is rounding, not decay.
NO_DECAY = 1e-9


def expected_value(sensor, minutes, temperature, vacuum, moisture, standard, warming=WARMING_MINUTES) -> Column:
    """Noise-free value of a sensor ``minutes`` after cycle start."""
    t, setpoint, floor = col(minutes), col(temperature), col(vacuum)
    drying = t - F.lit(float(warming))
    heat = F.when(
        t <= warming,
        F.lit(AMBIENT_TEMPERATURE) + (setpoint - AMBIENT_TEMPERATURE) * (1.0 - F.exp(-t / F.lit(warming / 3.0))),
    ).otherwise(setpoint)
    pull = F.when(t <= warming, F.lit(ATMOSPHERIC_PRESSURE)).otherwise(F.greatest(
        floor + (F.lit(ATMOSPHERIC_PRESSURE) - floor) * F.exp(-drying / F.lit(VACUUM_TAU_MINUTES)), F.lit(VACUUM_FLOOR)
    ))
    rate = -F.log(col(moisture) / F.lit(INITIAL_MOISTURE)) / col(standard)
    decay = F.when(t <= warming, F.lit(INITIAL_MOISTURE)).otherwise(
        F.greatest(F.lit(INITIAL_MOISTURE) * F.exp(-rate * drying), F.lit(0.0))
    )
    sensor = col(sensor)
    return F.when(sensor == "temperature", heat).when(sensor == "vacuum", pull).when(sensor == "moisture", decay)


def expected_profile(
    readings: DataFrame, pairs: DataFrame, orders: DataFrame, materials: DataFrame, warming: float = WARMING_MINUTES,
    hot=PROBE,
) -> DataFrame:
    """Readings since cycle start with elapsed minutes and the expected value for the order's material. ``hot``: heavy
    order ids where known, see join_per_key."""
    spec = orders.select("order_id", "material_id").join(
        materials.select("material_id", "target_temperature_degC", "target_vacuum_mbar", "target_moisture_ppm",
                         "standard_cycle_minutes"), "material_id"
    ).drop("material_id")
    starts = pairs.select("order_id", "cycle_start_time").filter(F.col("cycle_start_time").isNotNull())
    rows = join_per_key(readings, starts.join(spec, "order_id"), "order_id", hot=hot).withColumn(
        "elapsed_minutes", minutes_between("cycle_start_time", "timestamp_opc")
    ).filter(F.col("elapsed_minutes") >= 0)
    expected = expected_value(
        "sensor_type", "elapsed_minutes", "target_temperature_degC", "target_vacuum_mbar", "target_moisture_ppm",
        "standard_cycle_minutes", warming,
    )
    return rows.select(*readings.columns, "elapsed_minutes", expected.alias("expected_value"))


def profile_residual(profile: DataFrame) -> DataFrame:
    """Actual minus expected, and in units of the sensor noise."""
    noise = F.create_map(*[F.lit(x) for pair in SENSOR_NOISE.items() for x in pair])
    residual = F.col("value") - F.col("expected_value")
    return profile.withColumn("residual", residual).withColumn("z_score", F.col("residual") / noise[F.col("sensor_type")])


def ewma(
    readings: DataFrame, alpha: float = 0.3, keys=CYCLE_CHANNEL, order=("timestamp_opc", "reading_id"),
    slice_minutes: int = 60,
) -> DataFrame:
    """Exponentially weighted mean per channel: m = x for the first reading, then alpha*x + (1-alpha)*m.

    Readings are numbered and cut into blocks of equal length. A block turns the mean before it, c, into
    keep^n * c + e, so windows run inside blocks only and the block results are handed on. The block length makes
    keep^n less than e^-60, far below double precision, so the result of a block is its own e."""
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be in (0, 1]")
    if alpha == 1:
        return readings.withColumn("ewma", F.col("value"))
    keep, keys = 1.0 - alpha, list(keys)
    block = math.ceil(60 / -math.log(keep))
    rows = OrderedSeries(readings, keys, list(order), slice_minutes).with_row_number("_n")
    share = F.when(F.col("_n") == 1, F.col("value")).otherwise(alpha * F.col("value"))
    place = F.pmod(F.col("_n") - 1, F.lit(block)).cast("double")
    rows = rows.withColumns({"_b": F.floor((F.col("_n") - 1) / block), "_p": place})
    # Scaled by keep^-p, at most e^60, so that a plain running sum gives the weighted one.
    running = W.partitionBy(*keys, "_b").orderBy("_p").rowsBetween(W.unboundedPreceding, W.currentRow)
    fade = F.pow(F.lit(keep), "_p")
    rows = rows.withColumn("_e", F.sum(share / fade).over(running) * fade)
    ends = rows.groupBy(*keys, (F.col("_b") + 1).alias("_b")).agg(F.max_by("_e", "_p").alias("_c"))
    joined = rows.join(ends, [*keys, "_b"], "left")
    mean = F.col("_e") + F.coalesce("_c", F.lit(0.0)) * F.pow(F.lit(keep), F.col("_p") + 1)
    return joined.withColumn("ewma", mean).drop("_n", "_b", "_p", "_e", "_c")


def alert_moisture_stalled(
    readings: DataFrame, percent: float = 5.0, window_minutes: int = 30, keys=("order_id",), slice_minutes: int = 60,
) -> DataFrame:
    """Moisture readings that did not fall by ``percent`` against the last reading at or before the start of the
    trailing window. Without such a reading the window is not full and nothing is raised. Where the readings carry a
    ``phase`` (see ``cycle_phase``) only those of the drying phase are compared, so the even moisture of warming
    and of finished cycles raises nothing."""
    moisture = readings.filter(F.col("sensor_type") == "moisture")
    if "phase" in readings.columns:
        moisture = moisture.filter(F.col("phase") == "drying")
    width = F.lit(int(window_minutes * MICROS_PER_MINUTE))
    probes = moisture.withColumn("_opens", F.timestamp_micros(micros("timestamp_opc") - width))
    seen = as_of_value(
        probes, moisture, list(keys), ("_opens", "reading_id"), ("timestamp_opc", "reading_id"),
        F.struct("timestamp_opc", "value"), "_first", width=slice_minutes,
    )
    stalled = F.col("value") > F.col("_first.value") * (1 - percent / 100.0)
    return seen.filter(stalled).select(
        *readings.columns, F.col("_first.timestamp_opc").alias("window_start"),
        F.col("_first.value").alias("window_start_value"),
    )


def _with_setpoint(series: DataFrame, setpoints: DataFrame, keys, how: str) -> DataFrame:
    """One row of setpoints per key: an oven or an order."""
    if len(keys) > 1:
        return series.join(setpoints, list(keys), how)
    return join_dimension(series, setpoints, keys[0], how)


def alert_temperature_spike(
    readings: DataFrame, jump: float = 20.0, keys=("order_id",), setpoints: DataFrame | None = None,
    tolerance: float = 2.0, slice_minutes: int = 60,
) -> DataFrame:
    """Temperature readings that jump by more than ``jump`` against the reading before, or exceed the setpoint
    (``setpoints``: keys and setpoint_temperature_degC) by more than the tolerance."""
    rows = readings.filter(F.col("sensor_type") == "temperature")
    series = OrderedSeries(rows, keys, ["timestamp_opc", "reading_id"], slice_minutes).with_previous(
        previous_value="value"
    )
    change = F.abs(F.col("value") - F.col("previous_value")) > jump
    reason = F.when(change, "jump")
    if setpoints is not None:
        series = _with_setpoint(series, setpoints.select(*keys, "setpoint_temperature_degC"), keys, "left")
        reason = reason.when(F.col("value") > F.col("setpoint_temperature_degC") + tolerance, "above setpoint")
        series = series.withColumn("reason", reason).drop("setpoint_temperature_degC")
    else:
        series = series.withColumn("reason", reason)
    return series.filter(F.col("reason").isNotNull())


def alert_vacuum_loss(
    readings: DataFrame, setpoints: DataFrame, keys=("order_id",), tolerance: float = 0.5, slice_minutes: int = 60,
) -> DataFrame:
    """Pressure above setpoint plus tolerance after it had once been reached (``setpoints``: keys and
    setpoint_vacuum_mbar)."""
    rows = readings.filter(F.col("sensor_type") == "vacuum")
    series = OrderedSeries(rows, keys, ["timestamp_opc", "reading_id"], slice_minutes).with_extreme(
        "lowest_before", F.col("value"), "min", inclusive=False
    )
    limit = F.col("setpoint_vacuum_mbar") + tolerance
    joined = _with_setpoint(series, setpoints.select(*keys, "setpoint_vacuum_mbar"), keys, "inner")
    return joined.filter((F.col("lowest_before") <= limit) & (F.col("value") > limit))


@dataclass(frozen=True)
class Rule:
    """An alert rule for streams: ``find`` gives the alerts among readings, ``context`` the readings up to an instant (micros) that
    later ones are compared with. ``find`` over these and all later readings gives the same alerts for the later ones."""

    find: Callable[[DataFrame], DataFrame]
    context: Callable[[DataFrame, int], DataFrame]


def moisture_stalled_rule(percent: float = 5.0, window_minutes: int = 30, keys=("order_id",)) -> Rule:
    """Keeps the trailing window of moisture and the last reading before it; the first dry one, too, which ends the drying phase."""

    def context(rows: DataFrame, mark: int) -> DataFrame:
        moisture = rows.filter(F.col("sensor_type") == "moisture")
        compared = moisture.filter(F.col("phase") == "drying") if "phase" in rows.columns else moisture
        opens = F.unix_micros("timestamp_opc") > mark - int(window_minutes * MICROS_PER_MINUTE)
        before = first_per_key(compared.filter(~opens), list(keys), [F.desc("timestamp_opc"), F.desc("reading_id")])
        kept = moisture.filter(opens).unionByName(before)
        if "phase" in rows.columns:
            done = first_per_key(moisture.filter(F.col("phase") == "complete"), ["order_id"], ["timestamp_opc", "reading_id"])
            kept = kept.unionByName(done)
        return kept

    return Rule(lambda rows: alert_moisture_stalled(rows, percent, window_minutes, keys), context)


def temperature_spike_rule(jump: float = 20.0, keys=("order_id",), setpoints: DataFrame | None = None, tolerance: float = 2.0) -> Rule:
    """Keeps the last temperature."""
    return Rule(
        lambda rows: alert_temperature_spike(rows, jump, keys, setpoints, tolerance),
        lambda rows, mark: first_per_key(rows.filter(F.col("sensor_type") == "temperature"), list(keys),
                                         [F.desc("timestamp_opc"), F.desc("reading_id")]))


def vacuum_loss_rule(setpoints: DataFrame, keys=("order_id",), tolerance: float = 0.5) -> Rule:
    """Keeps the lowest pressure."""
    return Rule(
        lambda rows: alert_vacuum_loss(rows, setpoints, keys, tolerance),
        lambda rows, mark: first_per_key(rows.filter(F.col("sensor_type") == "vacuum"), list(keys), ["value", "timestamp_opc", "reading_id"]))


def with_phase(readings: DataFrame, cycles: DataFrame, warming_minutes: float = WARMING_MINUTES) -> DataFrame:
    """Readings with the column ``phase`` of ``cycle_phase``, from one row per order (order_id, cycle_start_time,
    target_moisture_ppm). What is dry is decided among ``readings``."""
    one = cycles.select("order_id", F.col("order_id").alias("material_id"), "cycle_start_time", "target_moisture_ppm")
    return cycle_phase(readings, one, one, one, warming_minutes).drop("elapsed_minutes")


def cycle_end_eta(profile: DataFrame, targets: DataFrame, warming: float = WARMING_MINUTES) -> DataFrame:
    """Per cycle a straight line through ln(moisture) over minutes of the drying phase, the minute at which it
    meets the target, and R2. No estimate with fewer than two instants or without decay. ``targets`` holds order_id,
    target_moisture_ppm, cycle_start_time and, to estimate running cycles only, cycle_end_time (null while running)."""
    moisture = profile.filter(
        (F.col("sensor_type") == "moisture") & (F.col("value") > 0) & (F.col("elapsed_minutes") > warming)
    ).select("order_id", "elapsed_minutes", F.log("value").alias("_ln"))
    fits = moisture.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.regr_slope("_ln", "elapsed_minutes").alias("slope"),
        F.regr_intercept("_ln", "elapsed_minutes").alias("intercept"),
        F.regr_r2("_ln", "elapsed_minutes").alias("r2"),
    )
    return _estimated(fits, targets)


def _estimated(fits: DataFrame, targets: DataFrame) -> DataFrame:
    """Lines (order_id, n_readings, slope, intercept, r2) with the minute and the instant at which they meet the target."""
    if "cycle_end_time" in targets.columns:
        targets = targets.filter(F.col("cycle_end_time").isNull()).drop("cycle_end_time")
    minute = F.when(F.col("slope") < -NO_DECAY, (F.log("target_moisture_ppm") - F.col("intercept")) / F.col("slope"))
    return fits.join(targets, "order_id").withColumn("eta_minutes", minute).withColumn(
        "eta", F.timestamp_micros(
            (micros("cycle_start_time") + F.round(F.col("eta_minutes") * F.lit(6e7))).try_cast("bigint")
        )
    ).select("order_id", "n_readings", "slope", "intercept", "r2", "eta_minutes", "eta")


# Sums are taken around this point of the drying curve, so that their differences keep their digits.
ETA_MINUTES, ETA_LOG = 300.0, 7.0
ETA_SUMS = ["n_readings", "s_x", "s_y", "s_xx", "s_xy", "s_yy"]


def eta_sums(profile: DataFrame, warming: float = WARMING_MINUTES) -> DataFrame:
    """Per cycle the sums that a straight line through ln(moisture) over the drying minutes needs. Sums of parts of the readings add up
    (``merge_eta_sums``), so an estimate can follow a running cycle without its earlier readings."""
    moisture = profile.filter(
        (F.col("sensor_type") == "moisture") & (F.col("value") > 0) & (F.col("elapsed_minutes") > warming))
    rows = moisture.select("order_id", (F.col("elapsed_minutes") - ETA_MINUTES).alias("_x"), (F.log("value") - ETA_LOG).alias("_y"))
    x, y = F.col("_x"), F.col("_y")
    return rows.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_readings"), F.sum(x).alias("s_x"), F.sum(y).alias("s_y"), F.sum(x * x).alias("s_xx"),
        F.sum(x * y).alias("s_xy"), F.sum(y * y).alias("s_yy"), F.min(x).alias("first_x"), F.max(x).alias("last_x"))


def merge_eta_sums(sums: DataFrame) -> DataFrame:
    return sums.groupBy("order_id").agg(
        *[F.sum(c).alias(c) for c in ETA_SUMS], F.min("first_x").alias("first_x"), F.max("last_x").alias("last_x"))


def eta_from_sums(sums: DataFrame, targets: DataFrame) -> DataFrame:
    """The columns of ``cycle_end_eta`` from merged sums."""
    n, mean_x, mean_y = F.col("n_readings"), F.col("s_x") / F.col("n_readings"), F.col("s_y") / F.col("n_readings")
    several = F.col("last_x") > F.col("first_x")
    spread, both, height = (F.col("s_xx") - n * mean_x * mean_x, F.col("s_xy") - n * mean_x * mean_y,
                            F.col("s_yy") - n * mean_y * mean_y)
    fits = sums.select(
        "order_id", "n_readings", F.when(several, both / spread).alias("slope"),
        F.when(several, mean_y + ETA_LOG - both / spread * (mean_x + ETA_MINUTES)).alias("intercept"),
        F.when(several, F.when(height <= 0, F.lit(1.0)).otherwise(both * both / (spread * height))).alias("r2"))
    return _estimated(fits, targets)


def simulated_minutes(real_minutes, factor: float = COMPRESSION_FACTOR) -> Column:
    """Cycle minutes that pass in the given wall-clock minutes of a compressed run."""
    return col(real_minutes) * F.lit(float(factor))


def wall_minutes(cycle_minutes, factor: float = COMPRESSION_FACTOR) -> Column:
    return col(cycle_minutes) / F.lit(float(factor))


def resample(readings: DataFrame, minutes: int = 5, keys=("oven_id", "sensor_type"), gap_slots: int = 1000) -> DataFrame:
    """One row per channel and time bucket between its first and last reading: the last value, or a null value
    with is_gap. Missing buckets are generated in runs of at most ``gap_slots`` per row, so a long silence is
    spread over many rows before it is expanded."""
    width = int(minutes * MICROS_PER_MINUTE)
    rows = readings.withColumn("_slot", F.floor(micros("timestamp_opc") / width))
    filled = rows.groupBy(*keys, "_slot").agg(
        F.max_by("value", F.struct("timestamp_opc", "reading_id")).alias("value"), F.count(F.lit(1)).alias("n_readings")
    )
    ends = filled.groupBy(*keys).agg(F.min("_slot").alias("_from"), F.max("_slot").alias("_to"))
    chunk = F.floor(F.col("_from") / gap_slots)
    last_chunk = F.floor(F.col("_to") / gap_slots)
    chunks = ends.withColumn("_chunk", F.explode(F.sequence(chunk, last_chunk)))
    low = F.greatest(F.col("_from"), F.col("_chunk") * gap_slots)
    high = F.least(F.col("_to"), F.col("_chunk") * gap_slots + gap_slots - 1)
    # Spread by chunk before expanding: one channel may span most of the grid.
    grid = chunks.select(*keys, low.alias("_low"), high.alias("_high")).hint("rebalance", *keys, "_low")
    grid = grid.select(*keys, F.explode(F.sequence("_low", "_high")).alias("_slot"))
    joined = grid.join(filled, [*keys, "_slot"], "left")
    return joined.select(
        *keys, F.timestamp_micros(F.col("_slot") * width).alias("bucket"), "value",
        F.coalesce("n_readings", F.lit(0).cast("bigint")).alias("n_readings"),
        F.col("n_readings").isNull().alias("is_gap"),
    )


def ingest_lag(
    readings: DataFrame, start="timestamp_opc", end="timestamp_mqtt", by=("sensor_type",), sla_seconds=(10.0, 60.0),
    accuracy: int = 10000,
) -> DataFrame:
    """Lag in seconds between two clocks per group: percentiles, maximum and the rows over each SLA."""
    lag = (micros(end) - micros(start)) / F.lit(1e6)
    rows = readings.withColumn("_lag", lag)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.percentile_approx("_lag", F.lit(0.5), accuracy).alias("p50_seconds"),
        F.percentile_approx("_lag", F.lit(0.95), accuracy).alias("p95_seconds"),
        F.percentile_approx("_lag", F.lit(0.99), accuracy).alias("p99_seconds"),
        F.max("_lag").alias("max_seconds"),
        *[F.count_if(F.col("_lag") > s).alias(f"over_{int(s)}s") for s in sla_seconds],
    )


def lag_sketches(readings: DataFrame, start="timestamp_opc", end="timestamp_mqtt", by=("sensor_type",), k: int = 400) -> DataFrame:
    """Per day and group the lags in seconds as a mergeable quantile sketch (KLL, of size ``k``: ranks are off by about 1 / k), with
    count and maximum. Days are cut by ``start``."""
    rows = readings.select(*by, F.to_date(start).alias("day"), ((micros(end) - micros(start)) / F.lit(1e6)).alias("_lag"))
    return rows.filter(F.col("_lag").isNotNull()).groupBy("day", *by).agg(
        F.kll_sketch_agg_double("_lag", F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n_readings"), F.max("_lag").alias("max_seconds"))


def lag_percentiles(sketches: DataFrame, by=("sensor_type",), first_day=None, last_day=None, shares=(0.5, 0.95, 0.99)) -> DataFrame:
    """Percentiles over any range of days from ``lag_sketches`` alone; the readings are not read again. Sketches of one day may come
    in several parts."""
    rows = sketches
    if first_day is not None:
        rows = rows.filter(F.col("day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.filter(F.col("day") <= F.lit(last_day).cast("date"))
    merged = rows.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("_all"), F.sum("n_readings").alias("n_readings"),
                                   F.max("max_seconds").alias("max_seconds"))
    quantiles = [F.kll_sketch_get_quantile_double("_all", F.lit(p)).alias(f"p{round(100 * p)}_seconds") for p in shares]
    return merged.select(*by, "n_readings", *quantiles, "max_seconds")
