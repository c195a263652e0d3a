"""As-of join: the last trade at or before each decision, never one after it.

Two plans, chosen by counting the decisions. Few decisions are broadcast and every
trade is reduced, where it is read, to the winner of its decision or of its slice of
time, so only winners are shuffled. Otherwise trades and decisions are reduced
together to one row per (key, instant) with a map-side combine.

Either way a running window per (key, slice) finds the match inside a slice, and the
closing trade of the latest earlier slice enters it as one extra row
(:mod:`tidemark.functions.carry`). No window partition grows with a hot key.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window, functions as F

from tidemark.functions.carry import carried_rows
from tidemark.functions.quantiles import exact_quantile
from tidemark.functions.times import (
    HOUR, MINUTE, SECOND, from_micros, instant, is_ntz, micros, slice_no,
)
from tidemark.session import BROADCAST_ROWS, within, written

KEYS = ("venue", "symbol")


def normalise_decisions(raw: DataFrame, keys: Sequence[str] = KEYS,
                        query_time: str = "query_ts") -> DataFrame:
    """Parse, drop what does not parse, and keep each (key, instant) once."""
    kind = dict(raw.dtypes)[query_time]
    stamp = (F.try_to_timestamp(F.col(query_time)).cast("timestamp_ntz")
             if kind == "string" else F.col(query_time))
    return (
        raw.select(*keys, stamp.alias(query_time))
        .where(F.col(query_time).isNotNull())
        .dropDuplicates([*keys, query_time])
    )


def decision_grid(bars: DataFrame, keys: Sequence[str] = KEYS, newest: int | None = None,
                  offset_seconds: float = 17.5, bucket: str = "bucket") -> DataFrame:
    """Decision times off the bar edge: bar start plus an offset, the newest N per key."""
    shifted = from_micros(micros(bucket) + F.lit(int(offset_seconds * SECOND)),
                          is_ntz(bars, bucket))
    if newest is None:
        return bars.select(*keys, shifted.alias("query_ts"))
    # The newest N of a key are among the newest N of each of its days.
    day = Window.partitionBy(*keys, F.to_date(bucket)).orderBy(F.desc(bucket))
    whole = Window.partitionBy(*keys).orderBy(F.desc(bucket))
    per_day = (bars.select(*keys, bucket).withColumn("_rn", F.row_number().over(day))
               .where(F.col("_rn") <= newest))
    return (
        per_day.withColumn("_rn", F.row_number().over(whole)).where(F.col("_rn") <= newest)
        .select(*keys, shifted.alias("query_ts"))
    )


def asof_join(decisions: DataFrame, trades: DataFrame, *, keys: Sequence[str] = KEYS,
              query_time: str = "query_ts", trade_time: str = "ts",
              tiebreak: str = "trade_id", carry: Sequence[str] = ("price",),
              strict: bool = False, until=None, prune_keys: bool = False,
              version: str | None = None, few_decisions: bool | None = None) -> DataFrame:
    """Left as-of join; one output row per distinct decision.

    Trades may hold replays and corrections that keep their time: with ``version`` the newest
    of one id wins its instant, so they need not be deduplicated, which would shuffle them all.

    A key with a null matches nothing, as in a join; such decisions stay, unmatched.
    ``strict`` matches strictly before instead of at-or-before. ``until`` is an upper
    bound of the decision times when the caller knows one; it reaches the scan. There
    is no lower bound: an old match must be found so that its age can be reported.
    ``prune_keys`` keeps only trades of keys that were asked for, through a broadcast
    semi join whose key list is counted first. ``few_decisions=False``
    skips counting the decisions and takes the plan for many.
    """
    keys = list(keys)
    prints = trades.where(F.col(trade_time).isNotNull())
    for key in keys:
        prints = prints.where(F.col(key).isNotNull())
    if until is not None:
        prints = prints.where(F.col(trade_time) <= instant(until))
    if prune_keys:
        wanted = decisions.select(*keys).distinct()
        if within(wanted):
            prints = prints.join(F.broadcast(wanted), keys, "left_semi")

    columns = [tiebreak, *carry]
    order = [tiebreak, *([VERSION] if version else []), *carry]
    prints = prints.select(*keys, micros(trade_time).alias("_trade_us"), *columns, *(
        [F.col(version).alias(VERSION)] if version else []))
    asked = decisions.select(*keys, micros(query_time).alias("_t"))
    small = None if few_decisions is False else _few(asked, keys)
    few_decisions = small is not None
    if few_decisions:
        asked, slice_us = small
        points = _snapped(prints, asked, keys, order, strict, slice_us)
    else:
        slice_us = MINUTE
        points = _instants(prints, asked, keys, order, strict, slice_us)

    row = F.when(F.col("_trade_us").isNotNull(), F.struct("_trade_us", *columns))
    entering = carried_rows(points, keys, "_slice", "_trade_us", columns).withColumns(
        {"_pos": F.col("_slice") * F.lit(2 * slice_us) - 1, "_asked": F.lit(False)})
    ordered = Window.partitionBy(*keys, "_slice").orderBy("_pos")
    upto = (ordered.rowsBetween(Window.unboundedPreceding, -1)
            if strict and not few_decisions
            else ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    stamp = from_micros((F.col("_pos") / 2).cast("bigint"), is_ntz(decisions, query_time))
    return (
        points.unionByName(entering, allowMissingColumns=True)
        .select(*keys, "_pos", "_asked", F.last(row, ignorenulls=True).over(upto).alias("_m"))
        .where("_asked")
        .select(*keys, stamp.alias(query_time),
                from_micros("_m._trade_us", is_ntz(trades, trade_time)).alias("trade_ts"),
                *[F.col(f"_m.{c}").alias(c) for c in columns])
    )


VERSION = "_version"
#: Most decisions one slice may hold for trades to look them up in place.
PER_SLICE = 64


def _few(asked: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int] | None:
    """The decisions by slice of an hour or a minute, stored, and the width; None if they are too many.

    One job: the slices are counted while they are written. Only a crowded hour costs a second one.
    """
    seen = Observation()
    by_hour = asked.dropDuplicates().groupBy(*keys, slice_no("_t", HOUR).alias("_slice")).agg(
        F.sort_array(F.collect_list("_t")).alias("_asks"))
    lookup = written(by_hour.observe(seen, F.sum(F.size("_asks")).alias("all"), F.max(F.size("_asks")).alias("most")),
                     "decisions")
    if (seen.get["all"] or 0) > BROADCAST_ROWS:
        return None
    if (seen.get["most"] or 0) <= PER_SLICE:
        return lookup, HOUR
    by_minute = lookup.select(*keys, F.explode("_asks").alias("_t")).groupBy(
        *keys, slice_no("_t", MINUTE).alias("_slice")).agg(F.sort_array(F.collect_list("_t")).alias("_asks"))
    crowded = by_minute.agg(F.max(F.size("_asks")).alias("most")).first()["most"]
    return None if crowded > PER_SLICE else (by_minute, MINUTE)


def _instants(prints: DataFrame, asked: DataFrame, keys: Sequence[str], columns: Sequence[str],
              strict: bool, slice_us: int) -> DataFrame:
    """One row per (key, instant): whether it was asked for, and the trade that wins it.

    The map-side combine also bounds an instant that holds a large share of all rows.
    """
    events = prints.select("*", F.col("_trade_us").alias("_t"), F.lit(False).alias("_asked"))
    both = events.unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    return (
        both.groupBy("_t", *keys)
        .agg(F.max(F.struct("_trade_us", *columns)).alias("_w"), F.max("_asked").alias("_asked"))
        .select(*keys, slice_no("_t", slice_us).alias("_slice"), (F.col("_t") * 2).alias("_pos"),
                "_asked", "_w.*")
    )


def _snapped(prints: DataFrame, asked: DataFrame, keys: Sequence[str], columns: Sequence[str],
             strict: bool, slice_us: int) -> DataFrame:
    """Trades reduced, where they are read, to the winner of each decision and slice.

    ``asked`` holds the sorted decisions of each slice. A trade belongs to the first of its slice that may see it, or to the end
    of the slice. Only the winners are shuffled: at most one row per decision and per
    (key, slice) from each task, however many trades there are.
    """
    placed = (
        prints.withColumn("_slice", slice_no("_trade_us", slice_us))
        .join(F.broadcast(asked.select(*keys).distinct()), list(keys), "left_semi")
        .join(F.broadcast(asked), [*keys, "_slice"], "left"))
    at = F.col("_trade_us")
    seen_by = F.try_element_at(
        F.filter("_asks", lambda q: q > at if strict else q >= at), F.lit(1))
    pos = F.coalesce(seen_by * 2, (F.col("_slice") + 1) * F.lit(2 * slice_us) - 1)
    # The position leads the grouping: the sort below it compares longs, rarely names.
    winners = (
        placed.groupBy(pos.alias("_pos"), *keys)
        .agg(F.max(F.struct("_trade_us", *columns)).alias("_w"))
        .select(*keys, slice_no("_w._trade_us", slice_us).alias("_slice"), "_pos",
                F.lit(False).alias("_asked"), "_w.*"))
    return winners.unionByName(
        asked.select(*keys, "_slice", F.explode("_asks").alias("_t")).select(
            *keys, "_slice", (F.col("_t") * 2).alias("_pos"), F.lit(True).alias("_asked")),
        allowMissingColumns=True)


def with_staleness(matched: DataFrame, max_staleness_seconds: float = 60.0,
                   query_time: str = "query_ts", price: str = "price") -> DataFrame:
    """Age of the match; past the bound the price is nulled and the row kept."""
    age_us = micros(query_time) - micros("trade_ts")
    bound = int(max_staleness_seconds * SECOND)
    return (
        matched.withColumn("staleness_seconds", age_us / F.lit(float(SECOND)))
        .withColumn("stale", F.coalesce(age_us > F.lit(bound), F.lit(True)))
        .withColumn(price, F.when(age_us <= F.lit(bound), F.col(price)))
    )


def staleness_summary(aged: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Median and worst age of the matches of each key."""
    ages = written(aged.where(F.col("staleness_seconds").isNotNull()).select(*keys, "staleness_seconds"), "ages")
    return ages.groupBy(*keys).agg(F.max("staleness_seconds").alias("worst_age")).join(
        exact_quantile(ages, keys, "staleness_seconds", 0.5, "median_age"), list(keys))


def every_kth(decisions: DataFrame, k: int, keys: Sequence[str] = KEYS,
              query_time: str = "query_ts") -> DataFrame:
    """Every k-th decision of each key in time order, for decisions on a bar grid.

    A grid has at most one decision per bar, so a key's window is bounded by the
    calendar.
    """
    order = Window.partitionBy(*keys).orderBy(query_time)
    return decisions.withColumn("_rn", F.row_number().over(order) - 1).where(
        F.col("_rn") % k == 0).drop("_rn")
