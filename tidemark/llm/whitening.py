"""Whitening of vectors onto the leading components of their covariance.

The distinct vectors are written once. Tasks reduce them to counts and sums, then to
products of what is left after an integer near the mean is taken off, so that the products
stay exact as long as sums fit 53 bits; Spark adds the partial products up position by position.
The covariance, as large as a vector squared, is decomposed by :mod:`tidemark.llm.feast`, and
the rows are projected where they lie. The covariance of the projected distinct vectors is
measured, not derived.

Rows: a vector that is null or holds a null or a non-finite entry goes, as does one whose
entries leave the range of the scaled integers (beyond 2**56). An empty vector has no
component and gives no row. Vectors of different lengths are fitted apart, each length as a
table of its own. Repeated rows and rows without id are all given. Components with an
eigenvalue that is zero up to rounding do not exist; a single vector therefore gives no row. A
deviation beyond a long is null. An empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.feast import leading_pairs
from tidemark.session import discard, written

COMPONENTS = 16
SCALE, SHIFT, BEYOND = 64, 1_000_000, 2.0 ** 56
SUMS = "dims int, i int, j int, value double"
COUNTED = "dims int, place int, value decimal(38,0)"
WHITENED = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
            "explained double, identity_error double")
AT_ONCE = 8192


def scaled(vector: Column) -> Column:
    """Entries as integers floor(64 c) + 1,000,000."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)


def usable(vector: Column) -> Column:
    """True if every entry is a finite number within range; NaN counts as above every bound."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & (
        F.abs(c.cast("double")) < F.lit(BEYOND))), F.lit(False)) & (F.size(vector) > 0)


def by_length(batch: pa.RecordBatch, column: str):
    """Length, rows and int64 matrix of the vectors of each length in a batch."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    if len(sizes) and (sizes == sizes[0]).all():
        yield int(sizes[0]), np.arange(len(sizes)), values.reshape(len(sizes), -1)
        return
    starts = np.cumsum(sizes) - sizes
    for dims in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dims)
        yield dims, rows, values[starts[rows][:, None] + np.arange(dims)]


def exact_sum(x: np.ndarray) -> list[int]:
    """Column sums as Python integers: high and low halves are added apart."""
    low, high = x & 0xFFFFFFFF, x >> 32
    return [(int(h) << 32) + int(s) for h, s in zip(high.sum(axis=0), low.sum(axis=0))]


def count_and_sum(batches):
    """Place -1 holds the number of rows, the others the sums of the entries, per length."""
    total: dict[int, list[int]] = {}
    for batch in batches:
        for dims, rows, x in by_length(batch, "x"):
            part = [len(rows), *exact_sum(x)]
            total[dims] = [a + b for a, b in zip(total.get(dims, [0] * (dims + 1)), part)]
    for dims, sums in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dims] * len(sums), pa.int32()), pa.array(range(-1, dims), pa.int32()),
             pa.array(sums, pa.decimal128(38, 0))], names=["dims", "place", "value"])


def products(centre: dict[int, np.ndarray]):
    """Sums of the products of centred entries, upper half, one row for each pair of places."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, _, x in by_length(batch, "x"):
                y = (x - centre[dims]).astype(np.float64)
                total[dims] = total.get(dims, 0) + y.T @ y
        for dims, gram in total.items():
            yield upper(dims, gram)
    return run


def upper(dims: int, gram: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(gram))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(i), dims, np.int32)), pa.array(i.astype(np.int32)),
         pa.array(j.astype(np.int32)), pa.array(gram[i, j])], names=["dims", "i", "j", "value"])


def symmetric(rows, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def added(parts: DataFrame) -> dict[int, list]:
    """Partial products added up in Spark; as many rows come back as a vector has pairs of places."""
    found: dict[int, list] = {}
    for r in parts.groupBy("dims", "i", "j").agg(F.sum("value").alias("value")).collect():
        found.setdefault(r["dims"], []).append(r)
    return found


class Fit:
    """What the rows of one length are measured by."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
        self.rest = [s - n * int(c) for s, c in zip(sums, self.centre)]
        self.shift = np.array([r / n for r in self.rest])

    def decompose(self, spark, gram: np.ndarray, k: int) -> None:
        cov = gram / self.n - np.outer(self.shift, self.shift)
        value, vector = leading_pairs(spark, cov, k)
        self.explained = value / np.trace(cov) if len(value) else value
        self.onto = vector / np.sqrt(value)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) - self.shift) @ self.onto

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exact; None if it leaves the range of a long."""
        y = x - self.centre
        far = float(np.abs(y).max(initial=0) + 1) * self.n
        if far * far * x.shape[1] < 2.0 ** 62:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        rows = [sum((self.n * v - r) ** 2 for v, r in zip(row, self.rest)) for row in y.tolist()]
        return [d if d < 1 << 63 else None for d in rows]


def whitened(vectors: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """One row for each usable vector and component up to ``k``, numbered by falling eigenvalue."""
    spark = vectors.sparkSession
    base = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                          F.col(vector_col).alias("v")).where(usable(F.col("v"))).select(
        "vec_id", scaled(F.col("v")).alias("x"))
    distinct = written(base.select("x").distinct(), "distinct-vectors")
    counted: dict[int, dict[int, int]] = {}
    for r in distinct.mapInArrow(count_and_sum, COUNTED).groupBy("dims", "place").agg(
            F.sum("value").alias("value")).collect():
        counted.setdefault(r["dims"], {})[r["place"]] = int(r["value"])
    fits = {d: Fit(c[-1], [c[j] for j in range(d)]) for d, c in counted.items()}
    centre = {d: f.centre for d, f in fits.items()}
    for d, rows in added(distinct.mapInArrow(products(centre), SUMS)).items():
        fits[d].decompose(spark, symmetric(rows, d), k)

    def measured(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dims, _, x in by_length(batch, "x"):
                z = fits[dims].whiten(x)
                z = np.hstack([z, np.ones((len(z), 1))])
                total[dims] = total.get(dims, 0) + z.T @ z
        for dims, gram in total.items():
            yield upper(dims, gram)

    error = {}
    for d, rows in added(distinct.mapInArrow(measured, SUMS)).items():
        size = fits[d].onto.shape[1]
        gram = symmetric(rows, size + 1) / fits[d].n
        mean = gram[:size, size]
        error[d] = float(np.abs(gram[:size, :size] - np.outer(mean, mean) - np.eye(size)).max(
            initial=0))
    discard(distinct)

    def project(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                for dims, rows, x in by_length(batch, "x"):
                    yield projected(fits[dims], error[dims], batch.column("vec_id").take(
                        pa.array(rows)), x)

    return base.mapInArrow(project, WHITENED)


def projected(fit: Fit, error: float, ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
    z = fit.whiten(x)
    rows, size = z.shape
    each = pa.array(np.repeat(np.arange(rows), size))
    columns = [ids.take(each), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
               pa.array(np.full(rows * size, fit.n, np.int64)),
               pa.array(fit.deviation(x), pa.int64()).take(each), pa.array(z.ravel()),
               pa.array(np.tile(fit.explained, rows)), pa.array(np.full(rows * size, error))]
    return pa.RecordBatch.from_arrays(columns, schema=pa.schema(
        [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()),
         ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()),
         ("identity_error", pa.float64())]))
