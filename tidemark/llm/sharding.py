"""Shards of nearly equal size by minimax contiguous partition.

Law ``bytes``: equal texts form a group, groups are hashed to a bounded, ordered list of
atoms, and the smallest shard capacity for which a greedy walk over the atom sizes needs no
more shards than asked is found by binary search; the walk with that capacity gives the cuts.
An atom above its share of what is left would set that capacity alone and leave other shards
empty, so such atoms get a shard of their own first and the search runs over the rest.

``shard_law="rows"`` and ``"key"`` are not offered: groups of equal texts decide here.

Rows: a null text has no bytes and shares a group with the empty text; its checksum is 0.
A null id is a row like any other. Repeated rows get slots of their own. An empty table
gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import written

ATOM_BITS = 15
CELLS = 64
OVERHEAD = 16


def walk(sizes: Column, capacity: Column) -> Column:
    """Number of shards that a greedy walk over the sizes needs."""
    start = F.struct(F.lit(1).alias("used"), F.lit(0).cast("bigint").alias("load"))

    def step(s, x):
        full = s["load"] + x > capacity
        return F.struct((s["used"] + full.cast("int")).alias("used"),
                        F.when(full, x).otherwise(s["load"] + x).alias("load"))

    return F.aggregate(sizes, start, step, lambda s: s["used"])


def least_capacity(sizes: Column, shards: Column, largest: Column, total: Column) -> Column:
    """Smallest capacity with which the walk needs at most ``shards``, by bisection."""
    low = F.greatest(largest, F.ceil(total / shards).cast("bigint"))
    high = F.ceil(total / shards).cast("bigint") + largest
    start = F.struct(low.alias("low"), F.greatest(low, high).alias("high"))

    def step(s, _):
        middle = s["low"] + F.expr("1L") * F.floor((s["high"] - s["low"]) / 2)
        fits = walk(sizes, middle) <= shards
        return F.when(s["low"] >= s["high"], s).otherwise(F.struct(
            F.when(fits, s["low"]).otherwise(middle + 1).alias("low"),
            F.when(fits, middle).otherwise(s["high"]).alias("high")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(62)), start, step, lambda s: s["low"])


def cuts(atoms: Column, capacity: Column) -> Column:
    """First atom of every shard but the first."""
    start = F.struct(F.lit(0).cast("bigint").alias("load"),
                     F.array().cast("array<int>").alias("at"))

    def step(s, a):
        full = s["load"] + a["bytes"] > capacity
        return F.struct(F.when(full, a["bytes"]).otherwise(s["load"] + a["bytes"]).alias("load"),
                        F.when(full, F.array_append(s["at"], a["atom"])).otherwise(s["at"])
                        .alias("at"))

    return F.aggregate(atoms, start, step, lambda s: s["at"])


def shard_plan(sizes: DataFrame, shards: int) -> DataFrame:
    """One row: the atoms with a shard of their own, and the cuts between the other atoms."""
    def giant(s, a):
        big = ~s["done"] & (s["k"] < shards - 1) & (a["bytes"] * (shards - s["k"]) > s["left"])
        return F.struct((s["k"] + big.cast("int")).alias("k"),
                        F.when(big, s["left"] - a["bytes"]).otherwise(s["left"]).alias("left"),
                        (~big).alias("done"),
                        F.when(big, F.array_append(s["own"], a["atom"])).otherwise(s["own"])
                        .alias("own"))

    one = sizes.agg(F.sort_array(F.collect_list(F.struct("atom", "bytes"))).alias("atoms"),
                    F.coalesce(F.sum("bytes"), F.lit(0)).alias("total"))
    heavy = F.slice(F.sort_array(F.transform("atoms", lambda a: F.struct(
        a["bytes"].alias("bytes"), a["atom"].alias("atom"))), asc=False), 1, shards)
    start = F.struct(F.lit(0).alias("k"), F.col("total").alias("left"), F.lit(False).alias("done"),
                     F.array().cast("array<int>").alias("own"))
    one = one.withColumn("own", F.aggregate(heavy, start, giant, lambda s: s["own"]))
    one = one.withColumn("rest", F.filter("atoms", lambda a: ~F.array_contains("own", a["atom"])))
    sizes_of = F.col("rest")["bytes"]
    one = one.withColumn("capacity", F.when(F.size("rest") > 0, least_capacity(
        sizes_of, F.lit(shards) - F.size("own"), F.array_max(sizes_of),
        F.aggregate(sizes_of, F.lit(0).cast("bigint"), lambda s, x: s + x))).otherwise(0))
    return one.select(F.struct("own", cuts(F.col("rest"), F.col("capacity")).alias("at"))
                      .alias("plan"))


def shard_rows(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
               atom_bits: int = ATOM_BITS, cells: int = CELLS) -> DataFrame:
    """Every row with its size, checksum, shard and slot; slots count from 0 in each shard.

    ``atom_bits`` bounds the list of sizes (2**15 by default, 0.003 % of the rows each) and
    ``cells`` splits the rows of an atom by id, so that a hot text is numbered in parts.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = written(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - atom_bits).cast("int").alias("atom"),
        F.pmod(F.xxhash64(F.col(id_col).cast("bigint")), F.lit(cells)).cast("int").alias("cell"),
    ), "shard-sizes")
    tally = rows.groupBy("atom", "cell").agg(F.sum("size").alias("bytes"),
                                             F.count(F.lit(1)).alias("n"))
    plan = shard_plan(tally.groupBy("atom").agg(F.sum("bytes").alias("bytes")), shards)
    tally = tally.withColumn("plan", plan.scalar())
    own = F.array_position(F.col("plan")["own"], F.col("atom"))
    cut = F.size(F.filter(F.col("plan")["at"], lambda a: a <= F.col("atom")))
    tally = tally.select("atom", "cell", "n", F.when(own > 0, own - 1).otherwise(
        F.size(F.col("plan")["own"]) + cut).cast("int").alias("shard"))
    before = Window.partitionBy("shard").orderBy("atom", "cell").rowsBetween(
        Window.unboundedPreceding, -1)
    tally = tally.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    place = F.row_number().over(Window.partitionBy("atom", "cell").orderBy(
        "doc_id", "text_crc32", "size"))
    return rows.withColumn("place", place).join(tally, ["atom", "cell"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("place") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
