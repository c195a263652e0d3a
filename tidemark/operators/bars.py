"""OHLCV bars from deduplicated trades."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.times import (
    FREQUENCIES, SECOND, floor_to, from_micros, instant, is_ntz, micros,
)
from tidemark.session import versions_in_order

TRADE_GRAIN = ("venue", "symbol", "trade_id")


class MissingVersion(ValueError):
    """No usable version column, so the newest row of a grain cannot be told."""


def latest_per_grain(df: DataFrame, grain: Sequence[str], version: str = "ingested_at",
                     tiebreak: Sequence[str] = (), check_nulls: bool = False) -> DataFrame:
    """One row per grain, the most recently ingested.

    Each column is its own ``max_by`` over the same ordering: the buffers stay
    primitive (hash aggregation, map-side combine, so replays of one row collapse
    before the shuffle). The tie order reads every column: select what is wanted first. Rows of one grain see
    the columns in the same order, so a result row is never a mix of two inputs; of rows of one
    version that differ, a hash of the whole row decides, so reruns agree. A row
    without a version stays if its grain has no other.
    """
    if version not in df.columns:
        raise MissingVersion(f"no {version} column to order duplicates by; got {df.columns}")
    if check_nulls and not df.isEmpty() and df.where(F.col(version).isNotNull()).isEmpty():
        raise MissingVersion(f"{version} is null on every row")
    rest = [c for c in df.columns if c not in grain]
    order = F.struct(version, *tiebreak) if tiebreak else total_order(df, version, rest)
    return (
        df.groupBy(*grain)
        .agg(*[(F.max(version) if c == version and not tiebreak else F.max_by(c, order)).alias(c)
               for c in rest])
        .select(*df.columns)
    )


def total_order(df: DataFrame, version: str, rest: Sequence[str]) -> Column:
    """Version first, then a hash of the row. For dates and times one whole number, which hash
    aggregates can hold; otherwise a struct."""
    kind = df.schema[version].dataType
    others = [c for c in rest if c != version and not isinstance(df.schema[c].dataType, T.MapType)]
    tie = F.shiftrightunsigned(F.xxhash64(*(others or [version])), 2)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        at = micros(versions_in_order(df, version)).cast("decimal(19,0)")
        return at * F.lit(1 << 62).cast("decimal(19,0)") + tie.cast("decimal(19,0)")
    return F.struct(version, tie.alias("tie"))


def dedup_trades(trades: DataFrame, grain: Sequence[str] = TRADE_GRAIN) -> DataFrame:
    return latest_per_grain(trades, grain)


def ohlcv(trades: DataFrame, freq: str = "1m", start=None, end=None, *,
          keys: Sequence[str] = ("venue", "symbol"), time: str = "ts",
          deduplicated: bool = False, time_may_change: bool = False) -> DataFrame:
    """Bars on a calendar-aligned grid; only whole bars of ``[start, end)`` are returned.

    The range selects buckets, not rows. Catalyst cannot turn a predicate on the
    bucket into one on the trade time, so a time predicate one bar wider than the
    range is added here and reaches the scan. It runs before deduplication unless
    ``time_may_change`` says a correction can move a trade to another instant.
    """
    width = FREQUENCIES[freq] * SECOND
    ntz = is_ntz(trades, time)
    rows = trades
    if not time_may_change:
        if start is not None:
            # The first whole bar starts at or after `start`; earlier rows are not needed.
            rows = rows.where(F.col(time) >= instant(start))
        if end is not None:
            rows = rows.where(
                F.col(time) < instant(end) + F.expr(f"INTERVAL {width // SECOND} SECONDS"))
    if not deduplicated:
        read = dict.fromkeys([*TRADE_GRAIN, *keys, time, "price", "qty", "ingested_at"])
        rows = dedup_trades(rows.select(*(c for c in read if c in rows.columns)))
    order = F.struct(F.col("_us"), F.col("trade_id"))
    bars = (
        rows.withColumn("_us", micros(time))
        .groupBy(*keys, floor_to("_us", width).alias("_b"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("qty").alias("volume"),
            F.count(F.lit(1)).alias("trades"),
            F.sum(F.col("price") * F.col("qty")).alias("notional"),
        )
    )
    if start is not None:
        bars = bars.where(F.col("_b") >= micros(instant(start)))
    if end is not None:
        bars = bars.where(F.col("_b") < micros(instant(end)))
    return bars.select(*keys, from_micros("_b", ntz).alias("bucket"), "open", "high", "low",
                       "close", "volume", "trades", "notional")


def rollup(bars: DataFrame, freq: str, keys: Sequence[str] = ("venue", "symbol")) -> DataFrame:
    """Coarser bars from finer ones; equal to building them from the trades."""
    width = FREQUENCIES[freq] * SECOND
    ntz = is_ntz(bars, "bucket")
    return (
        bars.withColumn("_us", micros("bucket"))
        .groupBy(*keys, floor_to("_us", width).alias("_b"))
        .agg(
            F.min_by("open", "_us").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "_us").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("trades").alias("trades"),
            F.sum("notional").alias("notional"),
        )
        .select(*keys, from_micros("_b", ntz).alias("bucket"), "open", "high", "low",
                "close", "volume", "trades", "notional")
    )
