"""Exact quantiles of keys of any size.

A percentile aggregate keeps every value of a key in one buffer. Here values are counted in
ranges of their key's span, the range that holds the wanted rank is narrowed a second time, and only
the distinct values of what is left, a ``RANGES``-squared part of the span, are ranked. Every
step is a hash aggregation with a map-side combine, from stored values and the stored ranges of the step before.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import small, within, written

RANGES = 4096


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float = 0.5,
                   name: str = "quantile") -> DataFrame:
    """Per key the linearly interpolated quantile; null and NaN values do not count."""
    keys = list(keys)
    rows = written(df.select(*keys, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")), "quantile-values")
    place = F.lit(float(q)) * (F.col("_n") - 1)
    span = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    wanted = written(span.select(*keys, "_low", "_high", (place - F.floor(place)).alias("_part"), F.posexplode(
        F.array(F.floor(place), F.ceil(place))).alias("_side", "_rank")), "quantile-spans")
    # Both sides start from the same span: it is counted once.
    first = _ranges(rows, wanted.where("_side = 0"), keys).drop("_side")
    found = written(_picked(first.join(small(wanted.drop("_low", "_high")), keys), keys), "quantile-ranges")
    found = written(_picked(_ranges(rows, found, keys).join(
        small(found.drop("_low", "_high")), [*keys, "_side"]), keys), "quantile-ranges")
    values = _inside(rows, found, keys).groupBy(*keys, "_side", F.col("_v").alias("_range")).agg(
        F.count(F.lit(1)).alias("_count")).select(
        "*", F.col("_range").alias("_low"), F.col("_range").alias("_high"))
    exact = _picked(values.join(small(found.drop("_low", "_high")), [*keys, "_side"]), keys)
    low, high = (F.max(F.when(F.col("_side") == s, F.col("_low"))) for s in (0, 1))
    return exact.groupBy(*keys).agg((low + (high - low) * F.max("_part")).alias(name))


def _inside(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The values in the wanted spans. Only counted spans are broadcast: values are few bytes where they are
    stored, and left to itself the join may send all of them to the one task that holds the spans."""
    spans = wanted.select(*keys, "_side", "_low", "_high")
    both = rows.join(F.broadcast(spans), keys) if within(spans) else rows.hint("merge").join(spans, keys)
    return both.where(F.col("_v").between(F.col("_low"), F.col("_high")))


def _ranges(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and bounds of the values in equal parts of each wanted span."""
    width = F.col("_high") - F.col("_low")
    part = F.least(F.floor((F.col("_v") - F.col("_low")) / width * RANGES), F.lit(RANGES - 1))
    return _inside(rows, wanted, keys).select(
        *keys, "_side", "_v", F.when(width > 0, part).otherwise(0).alias("_range")).groupBy(
        *keys, "_side", "_range").agg(
        F.count(F.lit(1)).alias("_count"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))


def _picked(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """The range that holds the rank, and the rank inside it. A window holds at most the ranges of a key."""
    before = Window.partitionBy(*keys, "_side").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("_before", F.coalesce(F.sum("_count").over(before), F.lit(0)))
    return placed.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_count"))).select(
        *keys, "_side", (F.col("_rank") - F.col("_before")).alias("_rank"), "_part", "_low", "_high")
