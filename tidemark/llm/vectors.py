"""Exact top-k search by columnar branch-and-bound.

Rows are dealt to blocks of bounded size, and every block meets the queries in bounded
blocks. Inside a block the vectors stand column by column. Scores grow by a block of
dimensions at a time; a row whose score so far, plus the most that the lengths of the
remaining parts allow, lies below the k-th best lower bound is dropped, and the columns are
compacted to the rows that are left. Each pair of blocks gives k rows a query at most, and
these are ranked per query.

Rows: a vector that is null, empty or holds a null or a non-finite component takes no part,
as query or candidate; so does a row without id. Vectors meet only vectors of their own
length. Rows of one id are one query, that of the least vector, the shorter first; only this
row is no candidate for it, all other repeated rows are candidates each. An empty table gives an empty result; other columns are ignored.
Components up to about 2**40 are exact.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import written

ROWS_AT_ONCE = 4096
DIMS_AT_ONCE = 8
SCALE = 256
FOUND = "query_id bigint, vec_id bigint, score bigint"


def best_of_block(ids: np.ndarray, numbers: np.ndarray, columns: np.ndarray, own: int,
                  query: np.ndarray, k: int, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows of a block for one query.

    ``own`` is the number of the query's row. ``columns`` is (dimension, row); ``rest[j]`` holds each row's length from the j-th block of
    dimensions on.
    """
    dims = len(query)
    keep = np.flatnonzero(numbers != own)
    score = np.zeros(len(keep))
    for j, lo in enumerate(range(0, dims, DIMS_AT_ONCE)):
        hi = min(lo + DIMS_AT_ONCE, dims)
        score = score + query[lo:hi] @ columns[lo:hi, keep]
        if len(keep) > k and hi < dims:
            mass = np.sqrt(float(query[hi:] @ query[hi:])) * rest[j + 1][keep]
            mass = mass * (1 + 1e-9) + 1e-6
            least = np.partition(score - mass, len(score) - k)[len(score) - k]
            stay = score + mass >= least
            if not stay.all():
                keep, score = keep[stay], score[stay]
    order = np.lexsort((ids[keep], -score))[:k]
    return ids[keep][order], score[order]


def search_block(k: int, queries: pa.Table, rows: pa.Table) -> pa.Table:
    ids = rows.column("vec_id").to_numpy()
    empty = pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
    if len(ids) == 0 or queries.num_rows == 0:
        return empty
    columns = matrix(rows)
    parts = [np.sqrt((columns[lo:] ** 2).sum(axis=0)) for lo in range(0, len(columns), DIMS_AT_ONCE)]
    asked, wanted = queries.column("query_id").to_numpy(), matrix(queries)
    numbers, own = rows.column("row").to_numpy(), queries.column("row").to_numpy()
    found = [(np.full(len(i), q), i, s) for c, q in enumerate(asked)
             for i, s in [best_of_block(ids, numbers, columns, own[c], wanted[:, c], k, parts)]]
    return pa.table({n: np.concatenate([f[c] for f in found]).astype(np.int64)
                     for c, n in enumerate(("query_id", "vec_id", "score"))})


def matrix(rows: pa.Table) -> np.ndarray:
    """(dimension, row) of the vectors, which have one length."""
    flat = rows.column("v").combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    values = flat.flatten().to_numpy().astype(np.float64)
    return np.ascontiguousarray(values.reshape(rows.num_rows, -1).T)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id",
          vector_col: str = "embedding", rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """The ``k`` highest integer inner products of every query; ties go to the smaller id.

    Queries are the rows whose id is divisible by ``every``.
    """
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * SCALE).cast("double"))
    sound = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (
        F.abs(c.cast("double")) < float("inf")))
    numbered = written(vectors.select(id_col, vector_col).withColumn(
        "row", F.monotonically_increasing_id()), "vectors")
    base = numbered.where(F.col(id_col).isNotNull() & F.coalesce(sound, F.lit(False)) & (
        F.size(vector_col) > 0)).select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("v"),
                                        F.size(vector_col).alias("dims"), "row")
    n = max(1, numbered.count())
    blocks = -(-n // rows_at_once)
    groups = -(-n // (every * rows_at_once))
    rows = base.withColumn("block", F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)).cast("int")).withColumn(
        "ask", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    first = base.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(
        F.min(F.struct("dims", "v", "row")).alias("q")).select("vec_id", "q.*")
    asked = first.select(
        F.col("vec_id").alias("query_id"), "v", "dims", "row",
        F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("ask"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    keys = ["dims", "block", "ask"]

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        return search_block(k, queries, block)

    found = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
  CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
