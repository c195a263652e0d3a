"""Column expressions shared by the operators."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def count_between(text: Column, gap: str) -> Column:
    """Number of non-empty stretches between matches of ``gap``; 0 for a null text.

    Only the outermost stretches can be empty, since matches are as long as possible.
    """
    return let(F.split(F.coalesce(text, F.lit("")), gap, -1), lambda p: F.size(p) - (
        F.element_at(p, 1) == "").cast("int") - F.when(F.size(p) > 1, (
            F.element_at(p, -1) == "").cast("int")).otherwise(0)).cast("bigint")
