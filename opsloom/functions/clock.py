"""Timestamp arithmetic. Weekdays count from Monday = 0, as in ``F.weekday``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsloom.errors import ConfigurationError

HOUR_MICROS = 3_600_000_000


def micros(ts: Column | str) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def minutes_between(start: str, end: str) -> Column:
    return (micros(end) - micros(start)) / F.lit(60_000_000.0)


def hours_between(start: str, end: str) -> Column:
    return (micros(end) - micros(start)) / F.lit(float(HOUR_MICROS))


def shift(ts: Column, *, hours: int = 0, minutes: int = 0) -> Column:
    return F.timestamp_add("MINUTE", F.lit(hours * 60 + minutes), ts)


def interval_micros(frequency: str) -> int:
    """Length of a fixed interval such as ``"1h"``, ``"15min"`` or ``"30s"`` in microseconds."""
    units = {"s": 1_000_000, "min": 60_000_000, "h": HOUR_MICROS, "d": 24 * HOUR_MICROS}
    number = frequency.rstrip("abcdefghijklmnopqrstuvwxyz").strip()
    unit = frequency[len(number) :].strip()
    if unit not in units:
        raise ConfigurationError(f"unknown interval {frequency!r}")
    length = round(float(number or 1) * units[unit])
    if length <= 0:
        raise ConfigurationError("frequency must be positive")
    return length


def floor_to_interval(ts: str | Column, frequency: str = "1h") -> Column:
    """Start of the interval that holds ``ts``."""
    length = interval_micros(frequency)
    if length == HOUR_MICROS:
        return F.date_trunc("hour", ts)
    value = micros(ts)
    return F.timestamp_micros(value - F.pmod(value, F.lit(length)))


def interval_sequence(first: str, last: str, frequency: str = "1h") -> Column:
    """All interval starts from ``first`` to ``last``, both included."""
    seconds = interval_micros(frequency) / 1_000_000
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))
    return F.sequence(F.col(first), F.col(last), step)
