"""Time helpers. All timestamps are UTC instants; minutes are exact micros divided by 6e7."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros(ts) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def minutes_between(start, end) -> Column:
    return (micros(end) - micros(start)) / F.lit(6e7)


def to_utc(text) -> Column:
    """Any offset, ``Z`` or naive text to a UTC instant (naive means UTC); null when it is not a timestamp."""
    return col(text).try_cast("timestamp")


def as_of_column(as_of) -> Column:
    """A literal, a column or None (now) as a timestamp."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def time_slot(ts, minutes) -> Column:
    """Number of the fixed-width time slot that holds ``ts``."""
    return F.floor(micros(ts) / F.lit(int(minutes * MICROS_PER_MINUTE)))


def slot_start(ts, minutes) -> Column:
    return F.timestamp_micros(time_slot(ts, minutes) * F.lit(int(minutes * MICROS_PER_MINUTE)))
