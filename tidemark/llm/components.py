"""Connected components by alternating large and small stars, as grouped minima and joins."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import discard, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for every node of a link.

    A round hooks the larger neighbours of each node to the smallest of them, then the smaller
    ones; the number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder, so a lost executor costs one round. Ids must not be null.
    """
    edges = written(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        hooked = small.where(F.col("v") > F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, written(hooked.unionByName(
            low.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.sum("u"), F.sum(
            F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        roots.withColumn("label", F.col("node")))
