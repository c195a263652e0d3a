"""Last-known-value across slices of time, without one task per key.

A window partitioned by key alone puts every row of a hot key into one task. Here
rows are cut into (key, slice of time). Each slice is reduced to its closing row,
and only those travel through a per-key window: their number is bounded by the
calendar (525,600 minutes a year), never by the number of rows. The value carried
into a slice re-enters it as one extra row, so no join is needed.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.times import MINUTE, slice_no

CARRIED = "_carried"


def closing_rows(points: DataFrame, keys: Sequence[str], slice_col: str, time_us: str,
                 columns: Sequence[str]) -> DataFrame:
    """Per (keys, slice): the columns of the latest row whose ``time_us`` is not null."""
    return points.groupBy(*keys, slice_col).agg(
        F.max(time_us).alias(time_us), *[F.max_by(c, time_us).alias(c) for c in columns])


def carried_rows(points: DataFrame, keys: Sequence[str], slice_col: str, time_us: str,
                 columns: Sequence[str]) -> DataFrame:
    """Per (keys, slice): time and columns of the closing row of the latest earlier slice."""
    before = (
        Window.partitionBy(*keys).orderBy(slice_col)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    row = F.when(F.col(time_us).isNotNull(), F.struct(time_us, *columns))
    return (
        closing_rows(points, keys, slice_col, time_us, columns)
        .select(*keys, slice_col, F.last(row, ignorenulls=True).over(before).alias(CARRIED))
        .where(F.col(CARRIED).isNotNull())
        .select(*keys, slice_col, f"{CARRIED}.*")
    )


def lag_sliced(df: DataFrame, keys: Sequence[str], time_us: str, columns: Sequence[str],
               width: int = MINUTE, prefix: str = "prev_") -> DataFrame:
    """Previous row's columns per key; ``time_us`` (long) must be unique within a key."""
    keys, columns = list(keys), list(columns)
    base = df.withColumn("_slice", slice_no(time_us, width))
    carried = carried_rows(base, keys, "_slice", time_us, columns).withColumn(
        CARRIED, F.lit(True))
    inside = Window.partitionBy(*keys, "_slice").orderBy(time_us)
    return (
        base.withColumn(CARRIED, F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .select("*", *[F.lag(c).over(inside).alias(f"{prefix}{c}") for c in columns])
        .where(~F.col(CARRIED))
        .drop("_slice", CARRIED)
    )
