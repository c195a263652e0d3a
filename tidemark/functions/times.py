"""Instants as microseconds, bars and slices as integer arithmetic on them.

``date_trunc`` and ``window`` go through calendar code for every row; flooring a
long stays inside generated code and lets a range predicate reach the scan.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 3_600 * SECOND
DAY = 86_400 * SECOND

#: Bar widths in seconds.
FREQUENCIES = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600, "1d": 86400}


def as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros(value) -> Column:
    """Microseconds since the epoch of a timestamp, a naive timestamp or a date."""
    return F.unix_micros(as_col(value).cast("timestamp"))


def from_micros(value, ntz: bool = True) -> Column:
    stamp = F.timestamp_micros(as_col(value))
    return stamp.cast("timestamp_ntz") if ntz else stamp


def is_ntz(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes)[name] == "timestamp_ntz"


def slice_no(value, width: int) -> Column:
    """Index of the fixed-width slice a microsecond value falls in (floor, also below zero)."""
    v = as_col(value)
    return ((v - F.pmod(v, F.lit(width))) / F.lit(width)).cast("long")


def floor_to(value, width: int) -> Column:
    v = as_col(value)
    return v - F.pmod(v, F.lit(width))


def bar_start(value, freq: str, ntz: bool = True) -> Column:
    return from_micros(floor_to(micros(value), FREQUENCIES[freq] * SECOND), ntz)


def instant(text) -> Column:
    """A literal instant in the session zone, comparable with both timestamp kinds."""
    return F.lit(str(text)).cast("timestamp_ntz")
