"""Leading eigenpairs of a symmetric matrix by contour integration.

The matrix is brought to tridiagonal form once; there the inertia of V - s*I, the number of
eigenvalues above s, is a short recurrence. Inertia counts cut the wanted end of the spectrum
into slices of a few eigenvalues. Every slice is one row of a DataFrame: its task
integrates the resolvent around the slice (complex shifted solves at Gauss-Legendre nodes of a
half circle), which projects a random block onto the eigenvectors inside, and a Rayleigh-Ritz
step takes them out. A slice is done when as many pairs have converged as the inertia counts;
otherwise it goes on with its Ritz vectors, from time to time with a wider block.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

NODES = 8
IN_A_SLICE = 6
TOLERANCE = 1e-13
ROUNDS = 24
PAIRS = "value double, vector array<double>"


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar matrix, by Householder steps."""
    a = v.copy()
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        if length == 0:
            continue
        x[0] += length if x[0] >= 0 else -length
        x /= np.linalg.norm(x)
        a[k + 1:, :] -= 2 * np.outer(x, x @ a[k + 1:, :])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues above each of ``at``: positive pivots of the shifted form."""
    tiny = np.finfo(float).tiny * 4 / np.finfo(float).eps
    pivot = diagonal[0] - at
    count = (pivot > 0).astype(int)
    for d, b in zip(diagonal[1:], beside):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - at - b * b / pivot
        count += pivot > 0
    return count


def slices(v: np.ndarray, k: int, floor: float) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) that hold the ``k`` largest ones above ``floor``.

    Cuts lie in the middle of gaps. Eigenvalues closer than rounding stay in one slice,
    whatever their number.
    """
    diagonal, beside = tridiagonal(v)
    reach = np.abs(diagonal).max() + 2 * np.abs(beside).max(initial=0)
    high = reach * (1 + 1e-9)
    done: list[tuple[float, float, int]] = []
    open_ = [(floor, high, int(count_above(diagonal, beside, np.array([floor]))[0]), 0)]
    while open_ and sum(n for *_, n in done) < k:
        low, high, n, beyond = open_.pop()
        if n == 0:
            continue
        if n <= IN_A_SLICE or high - low < 1e-11 * reach:
            done.append((float(low), float(high), n))
            continue
        at = np.linspace(low, high, 66)
        above = count_above(diagonal, beside, at) - beyond
        above[0], above[-1] = n, 0
        inner = above[(above > 0) & (above < n)]
        if not len(inner):
            first = int(np.argmax(above == 0))
            open_.append((float(at[first - 1]), float(at[first]), n, beyond))
            continue
        counts, lengths = np.unique(inner, return_counts=True)
        wide = counts[lengths == lengths.max()]
        pick = int(wide[np.argmin(np.abs(wide - min(n / 2, k)))])
        run = np.flatnonzero(above == pick)
        cut = float((at[run[0]] + at[run[-1]]) / 2)
        open_ += [(low, cut, n - pick, beyond + pick), (cut, high, pick, beyond)]
    return done


def pairs_inside(v: np.ndarray, low: float, high: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` eigenpairs of ``v`` with values in (low, high)."""
    p = len(v)
    centre, radius = (low + high) / 2, (high - low) / 2
    node, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(-1j * np.pi / 2 * (node - 1))
    shifted = [(centre + radius * t) * np.eye(p) - v for t in turn]
    scale = max(np.abs(v).max(), np.finfo(float).tiny)
    rng = np.random.default_rng(p)
    block = rng.standard_normal((p, min(p, n + max(4, n // 2))))
    for attempt in range(1, ROUNDS + 1):
        if block.shape[1] < p:
            block = sum((w * radius * t / 2 * np.linalg.solve(s, block)).real
                        for w, t, s in zip(weight, turn, shifted))
        q, _ = np.linalg.qr(block)
        value, small = np.linalg.eigh(q.T @ v @ q)
        ritz = q @ small
        left = np.linalg.norm(v @ ritz - ritz * value, axis=0)
        good = (value > low) & (value < high) & (left <= TOLERANCE * p * scale)
        if good.sum() == n:
            return value[good], ritz[:, good]
        if q.shape[1] == p:
            inside = np.argsort(np.abs(value - centre))[:n]
            return value[inside], ritz[:, inside]
        block = ritz
        if attempt % 4 == 0:
            wider = min(p, 2 * block.shape[1])
            block = np.hstack([block, rng.standard_normal((p, wider - block.shape[1]))])
    raise ArithmeticError(f"{n} eigenvalues counted in ({low}, {high}) were not all found")


def leading_pairs(spark: SparkSession, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues that are zero up to rounding are left out. Each slice of the spectrum is solved
    in a task of its own; the matrix goes along with the task, its size is that of a vector
    squared.
    """
    p = len(v)
    floor = 1e-12 * p * np.abs(v).max(initial=0)
    wanted = slices(v, k, floor) if floor > 0 else []
    if not wanted:
        return np.zeros(0), np.zeros((p, 0))

    def solve(batches):
        for batch in batches:
            for low, high, n in zip(*(c.to_pylist() for c in batch.columns)):
                value, vector = pairs_inside(v, low, high, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value), pa.array(list(vector.T), pa.list_(pa.float64()))],
                    names=["value", "vector"])

    asked = spark.createDataFrame(wanted, "low double, high double, n int").repartition(len(wanted))
    found = asked.mapInArrow(solve, PAIRS).collect()
    if len(found) != sum(n for *_, n in wanted):
        raise ArithmeticError("eigenpairs are missing")
    q, _ = np.linalg.qr(np.array([r["vector"] for r in found]).T)
    value, small = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-value)[:k]
    vector = q @ small[:, order]
    lead = np.abs(vector).argmax(axis=0)
    return value[order], vector * np.sign(vector[lead, np.arange(len(order))])
