"""Trailing windows of bars that had closed by the decision.

A bar is labelled by its start, so containment is tested on its end. Which bars a
decision sees depends only on its place on the bar grid, so the statistics are
computed once per (key, grid position) and joined to the decisions; a window
frame never holds decisions, however densely they are packed.

The grid is cut into blocks as long as a window, so a window is the end of one block and the
start of the next. Running moments from either side of each block give both parts in
linear time, and the two are merged without a difference of large sums.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.quantiles import exact_quantile
from tidemark.functions.times import MINUTE, SECOND, micros
from tidemark.operators.asof import KEYS
from tidemark.session import written


def bar_returns(bars: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Return of each bar against the previous bar that exists, over full history.

    Bars are already aggregated: a key has at most 525,600 minute bars a year.
    """
    previous = F.lag("close").over(Window.partitionBy(*keys).orderBy("bucket"))
    return bars.withColumn("ret", F.try_divide(F.col("close"), previous) - 1)


def _grid(query_us, window_us: int, span_us: int, contaminated: bool):
    """First and last bar index a decision may use."""
    first = F.ceil((query_us - F.lit(window_us)) / F.lit(span_us)).cast("long")
    if contaminated:
        last = (F.ceil(query_us / F.lit(span_us)) - 1).cast("long")
    else:
        last = (F.floor(query_us / F.lit(span_us)) - 1).cast("long")
    return first, last


def attach_trailing(decisions: DataFrame, returns: DataFrame, *,
                    keys: Sequence[str] = KEYS, window_minutes: int = 30,
                    span_seconds: int = 60, query_time: str = "query_ts",
                    contaminated: bool = False, vol: str = "realised_vol",
                    count: str = "bars_in_window") -> DataFrame:
    """Sample deviation of bar returns and bar count over the window ending at each decision.

    ``contaminated`` admits the bar the decision falls inside, which is the error
    the audit measures.
    """
    keys = list(keys)
    window_us, span_us = window_minutes * MINUTE, span_seconds * SECOND
    first, last = _grid(micros(query_time), window_us, span_us, contaminated)
    asked = decisions.withColumn("_last", last).withColumn("_len", last - first + 1)
    # The window spans `whole` bars, give or take the one its edges cut.
    whole, cut = divmod(window_us, span_us)
    if contaminated:
        lengths = [whole, whole + 1] if cut else [whole]
    else:
        lengths = [n for n in (whole, whole - 1) if n > 0]
    # Decisions between the same two grid lines share an anchor; a window may hold no whole bar.
    anchors = asked.where(F.col("_len").isin(lengths)).select(*keys, "_last", "_len").dropDuplicates()
    place = F.floor(micros("bucket") / F.lit(span_us)).cast("long")
    bars = returns.select(*keys, place.alias("_pos"), "ret", F.lit(1).alias("_bar")).withColumn(
        "_len", F.explode(F.array(*(F.lit(n).cast("long") for n in lengths))))
    start = F.col("_last") - F.col("_len") + 1
    ends = anchors.select(*keys, "_len", "_last", F.col("_last").alias("_pos"), F.lit(1).alias("_side"))
    # The start of a window that fills a block is no part of the block before.
    starts = anchors.where(F.floor(start / F.col("_len")) < F.floor(F.col("_last") / F.col("_len"))).select(
        *keys, "_len", "_last", start.alias("_pos"), F.lit(0).alias("_side"))
    both = bars.unionByName(ends.unionByName(starts), allowMissingColumns=True).withColumn(
        "_block", F.floor(F.col("_pos") / F.col("_len")))

    block = Window.partitionBy(*keys, "_len", "_block")
    upto, onward = block.orderBy("_pos"), block.orderBy(F.desc("_pos"))

    def moments(frame):
        frame = frame.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        n = F.count("ret").over(frame)
        return F.struct(n.alias("n"), F.avg("ret").over(frame).alias("mean"),
                        (F.var_pop("ret").over(frame) * n).alias("m2"), F.count("_bar").over(frame).alias("bars"))

    parts = both.select(*keys, "_len", "_last", "_side", moments(upto).alias("_upto"),
                        moments(onward).alias("_onward")).where("_side IS NOT NULL").select(
        *keys, "_len", "_last", F.when(F.col("_side") == 1, F.col("_upto")).alias("_b"),
        F.when(F.col("_side") == 0, F.col("_onward")).alias("_a"))
    one = lambda side, f: F.coalesce(F.max(F.col(f"{side}.{f}")), F.lit(0.0 if f in ("mean", "m2") else 0))
    merged = parts.groupBy(*keys, "_last", "_len").agg(*(
        one(side, f).alias(f"{side}_{f}") for side in ("_a", "_b") for f in ("n", "mean", "m2", "bars")))
    n = F.col("_a_n") + F.col("_b_n")
    apart = F.col("_a_mean") - F.col("_b_mean")
    m2 = F.col("_a_m2") + F.col("_b_m2") + F.coalesce(F.try_divide(apart * apart * F.col("_a_n") * F.col("_b_n"), n), F.lit(0.0))
    stats = merged.select(*keys, "_last", "_len", F.when(n > 1, F.sqrt(m2 / (n - 1))).alias(vol),
                          (F.col("_a_bars") + F.col("_b_bars")).alias(count))
    return (
        asked.join(stats, [*keys, "_last", "_len"], "left")
        .select(*decisions.columns, vol, F.coalesce(F.col(count), F.lit(0)).alias(count))
    )


def lookahead_audit(decisions: DataFrame, returns: DataFrame, *,
                    keys: Sequence[str] = KEYS, window_minutes: int = 10) -> DataFrame:
    """Per decision: the correct volatility, the contaminated one and their ratio."""
    right = attach_trailing(decisions, returns, keys=keys, window_minutes=window_minutes,
                            vol="correct", count="_n")
    wrong = attach_trailing(right.drop("_n"), returns, keys=keys, contaminated=True,
                            window_minutes=window_minutes, vol="contaminated", count="_n")
    return (
        wrong.drop("_n").where(F.col("correct").isNotNull() & F.col("contaminated").isNotNull())
        .withColumn("ratio", F.try_divide(F.col("contaminated"), F.col("correct")))
    )


def audit_summary(audit: DataFrame, keys: Sequence[str] = ("symbol",),
                  threshold: float = 1.05) -> DataFrame:
    """Per key: decisions, median and worst ratio, and the share above a threshold."""
    stored = written(audit.select(*keys, "ratio"), "audit")
    whole = stored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("decisions"), F.max("ratio").alias("worst_ratio"),
        F.avg((F.col("ratio") > threshold).cast("double")).alias("share_over"))
    return whole.join(exact_quantile(stored, keys, "ratio", 0.5, "median_ratio"), list(keys), "left")
