"""What Gold needs of an order's events and readings, as partial states that can be merged in any order and grouping.

A state holds no row of its input: extremes, the last value with its position, an exact sum with its count. Merging
states of parts gives the state of the whole, so a stream adds the state of every batch and never reads an old reading again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT = "decimal(38,12)"
LAST = "struct<timestamp_opc: timestamp, reading_id: string, value: double>"
CONFIRMED = "struct<event_time: timestamp, event_id: string, operator_id: string, sap_confirmation_number: string>"
STATE = {
    "order_id": "string", "started": "timestamp", "confirmed": CONFIRMED, "peak_temperature": "double", "least_vacuum": "double",
    "last_moisture": LAST, "moisture_sum": EXACT, "moisture_rest": "double", "moisture_n": "bigint",
}
STATE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in STATE.items())


def _struct(kind: str, **values):
    fields = T._parse_datatype_string(kind).fields
    return F.struct(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields])


def _aggregates() -> list:
    """Of the columns of ``_spread``."""
    return [
        F.min("started").alias("started"), F.max("confirmed").alias("confirmed"),
        F.max("peak_temperature").alias("peak_temperature"), F.min("least_vacuum").alias("least_vacuum"),
        F.max("last_moisture").alias("last_moisture"), F.sum("moisture_sum").cast(EXACT).alias("moisture_sum"),
        F.sum("moisture_rest").alias("moisture_rest"), F.sum("moisture_n").alias("moisture_n"),
    ]


def order_partials(rows: DataFrame) -> DataFrame:
    """One state per order of ``rows``: cycle events with parsed payload and Silver readings in one table, told apart by
    event_type and sensor_type; other rows only name their order, and rows without one are a group of their own. Events may come
    as copies, readings may not. Sums are
    decimals with twelve places, which add up exactly; values beyond them (10^26, not a number) go to a sum of doubles."""
    event, value = F.col("event_type"), F.col("value")
    sensor = lambda name: F.col("sensor_type") == name
    moisture, exact = sensor("moisture"), F.col("value").try_cast(EXACT)
    spread = {
        "started": F.when(event == "cycle_started", F.col("event_time")),
        "confirmed": F.when(event == "cycle_confirmed", _struct(CONFIRMED)),
        "peak_temperature": F.when(sensor("temperature"), value), "least_vacuum": F.when(sensor("vacuum"), value),
        "last_moisture": F.when(moisture, _struct(LAST)), "moisture_sum": F.when(moisture, exact),
        "moisture_rest": F.when(moisture & exact.isNull(), value), "moisture_n": F.when(moisture & value.isNotNull(), F.lit(1)),
    }
    return rows.select("order_id", *[c.alias(n) for n, c in spread.items()]).groupBy("order_id").agg(*_aggregates())


def merge_partials(states: DataFrame) -> DataFrame:
    """One state per order from any number of partial ones."""
    return states.groupBy("order_id").agg(*_aggregates())


def pairs_of(states: DataFrame) -> DataFrame:
    """The columns of ``cycle_pairs`` from merged states."""
    return states.filter(F.col("started").isNotNull() | F.col("confirmed").isNotNull()).select(
        "order_id", F.col("started").alias("cycle_start_time"), F.col("confirmed.event_time").alias("cycle_end_time"),
        "confirmed.operator_id", "confirmed.sap_confirmation_number")


def sensor_stats_of(states: DataFrame) -> DataFrame:
    """The columns of ``cycle_sensor_stats`` from merged states."""
    total = F.coalesce(F.col("moisture_sum").cast("double"), F.lit(0.0)) + F.coalesce("moisture_rest", F.lit(0.0))
    return states.select(
        "order_id", F.col("peak_temperature").alias("peak_temperature_degC"), F.col("least_vacuum").alias("min_vacuum_mbar"),
        F.col("last_moisture.value").alias("final_moisture_ppm"),
        F.when(F.col("moisture_n") > 0, total / F.col("moisture_n")).alias("avg_moisture_ppm"))
