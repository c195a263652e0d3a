"""Mixing sources to target weights by weighted fair queueing.

Each source is shuffled by a digest of its ids and read up to three times over. A copy of a
document gets a virtual finish time, the words of its source up to and including it divided
by the source's target; copies are taken in the order of that time until the budget, the
words of the whole table, is used up. Running sums are kept over buckets of the shuffled
order and of the time, so no source and no stretch of time is sorted in one task.

Rows: a null text has no words, and nothing is taken from it. A null source is a source of
its own, after all others; a null id is shuffled like the empty one. Repeated rows count each.
An empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.columns import count_between
from tidemark.session import written

WEIGHTS = (1, 2, 3)
MOST = 3
SPACE = r"[\x20\x09-\x0D]+"
SLICES = 4096
LATEST = 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
                   ) -> DataFrame:
    """Target words of each source: by weight, at most ``most`` times its size, the excess reshared."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "rank", F.row_number().over(order)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    cap = F.col("source_size").cast("double") * most
    fill = Window.orderBy(cap / F.col("weight"), "rank")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(
        0, Window.unboundedFollowing)
    every = Window.partitionBy()
    s = (s.withColumn("left", F.sum(F.col("source_size").cast("double")).over(every)
                      - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
         .withColumn("weights", F.sum("weight").over(after))
         .withColumn("full", cap * F.col("weights") <= F.col("left") * F.col("weight")))
    first = F.min(F.when(~F.col("full"), F.struct(
        (cap / F.col("weight")).alias("r"), "rank", "left", "weights"))).over(every)
    s = s.withColumn("first", first)
    share = F.col("first")["left"] * F.col("weight") / F.col("first")["weights"]
    return s.select("source", "rank", "source_size",
                    F.when(F.col("full"), cap).otherwise(share).alias("target"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", slices: int = SLICES) -> DataFrame:
    """Every row with its words, its source's words and target, and the words the mix takes.

    ``mark`` is a hash of the text.
    """
    rows = written(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        count_between(F.col(text_col).cast("string"), SPACE).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("bigint").cast("string"), F.lit("")).cast("binary"))
        .alias("turn"), F.xxhash64(F.col(text_col).cast("string")).alias("mark"),
        F.monotonically_increasing_id().alias("row")), "mix-sizes")
    part = F.substring("turn", 1, 3)
    rows = rows.withColumn("part", part)
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    parts = parts.withColumn("before", F.coalesce(F.sum("words").over(
        Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    targets = source_targets(rows)
    parts = parts.alias("p").join(
        targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select(
        "p.source", "p.part", "p.before", "t.rank", "t.source_size", "t.target")
    inside = Window.partitionBy("source", "part").orderBy("turn", "doc_id", "size", "row")
    rows = rows.withColumn("upto", F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.alias("r").join(parts.alias("q"), F.col("r.source").eqNullSafe(F.col("q.source"))
                                & (F.col("r.part") == F.col("q.part")))
    finish = [F.when(F.col("q.target") > 0, (
        F.col("q.before") + F.col("r.upto") + e * F.col("q.source_size")).cast("double")
        / F.col("q.target")).otherwise(0.0) for e in range(MOST)]
    rows = written(rows.select("r.doc_id", "r.mark", "r.row", "r.size", "r.turn", "q.rank", "q.source_size",
                               "q.target", F.array(*finish).alias("finish")), "mix-times")
    copies = rows.where("size > 0").select(
        "row", "size", "turn", "doc_id", "rank", F.posexplode("finish").alias("copy", "time"))
    coarse = F.least(F.floor(F.col("time") * slices), F.lit(LATEST * slices)).cast("bigint")
    fine = F.least(F.floor((F.col("time") * slices - coarse) * slices), F.lit(LATEST * slices)
                   ).cast("bigint")
    copies = copies.withColumn("coarse", coarse).withColumn("fine", fine)
    budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    outer, used = edge(copies, "coarse", budget, 0)
    within = copies.where(F.col("coarse") == outer)
    inner, used = edge(within, "fine", budget, used)
    running = F.sum("size").over(Window.orderBy(
        "time", "rank", "turn", "doc_id", "copy", "row").rowsBetween(Window.unboundedPreceding, 0))
    last = within.where(F.col("fine") == inner).withColumn("running", running + used).where(
        F.col("running") <= budget)
    sure = within.where(F.col("fine") < inner)
    taken = sure.select("row").unionByName(last.select("row")).groupBy("row").agg(
        F.count(F.lit(1)).alias("more"))
    whole = F.size(F.filter("finish", lambda t: F.least(F.floor(t * slices), F.lit(
        LATEST * slices)).cast("bigint") < outer))
    return rows.join(taken, "row", "left").select(
        "doc_id", "mark", "size", "source_size", "target", F.when(F.col("size") > 0, (
            whole + F.coalesce("more", F.lit(0))) * F.col("size")).otherwise(0)
        .cast("bigint").alias("taken"))


def edge(copies: DataFrame, slice_col: str, budget: int, used: int) -> tuple[int, int]:
    """The slice of time in which the budget ends, and the words used before it.

    A slice after the last stands for a budget that all copies together do not use up.
    """
    order = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = copies.groupBy(F.col(slice_col).alias("slice")).agg(F.sum("size").alias("words"))
    sums = sums.withColumn("used", F.lit(used) + F.coalesce(F.sum("words").over(order), F.lit(0)))
    found = sums.where(F.col("used") + F.col("words") > budget).agg(
        F.min("slice"), F.min("used")).first()
    return (2**62, used) if found[0] is None else (found[0], found[1])


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn,
  CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s0),
s2 AS (SELECT *, CAST((rank - 1) % 3 + 1 AS DOUBLE) AS w, CAST(source_size AS DOUBLE) * 3 AS cap FROM s1),
s3 AS (SELECT *, sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, rank
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM s2),
s4 AS (SELECT *, cap * ws <= rest * w AS filled FROM s3),
s5 AS (SELECT rest, ws FROM s4 WHERE NOT filled ORDER BY cap / w, rank LIMIT 1),
s AS (SELECT source, rank, source_size, CASE WHEN filled THEN cap
  ELSE (SELECT rest FROM s5) * w / (SELECT ws FROM s5) END AS target FROM s4),
c AS (SELECT d.doc_id, d.size, d.turn, s.rank, s.source_size, s.target, sum(d.size) OVER (
  PARTITION BY s.rank ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
f AS (SELECT *, CASE WHEN target > 0 THEN CAST(upto + e * source_size AS DOUBLE) / target ELSE 0 END AS t
  FROM c, range(3) r(e)),
g AS (SELECT *, sum(size) OVER (ORDER BY t, rank, turn, doc_id, e ROWS UNBOUNDED PRECEDING) AS used FROM f WHERE size > 0),
k AS (SELECT doc_id, count(*) AS n FROM g WHERE used <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT c.doc_id, c.size, c.source_size, c.target, CAST(c.size * coalesce(k.n, 0) AS BIGINT) AS taken
FROM c LEFT JOIN k USING (doc_id)"""
