"""Whitening against numpy's own decomposition, with odd rows; slices of the spectrum alone."""
import math

import numpy as np
import pytest

from tidemark.llm import feast, whitening
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SHAPE = "vec_id long, embedding array<double>, x string, place int"


def plain(rows, k=16):
    """(vec_id, component) to whitened, with n, deviation, explained, from exact integers."""
    sound = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for dims in {len(x) for _, x in sound}:
        mine = [(i, x) for i, x in sound if len(x) == dims]
        fit = sorted({tuple(x) for _, x in mine})
        n, total = len(fit), [sum(c) for c in zip(*fit)]
        y = np.array([[n * a - s for a, s in zip(x, total)] for x in fit], float) / n
        cov = y.T @ y / n
        value, vector = np.linalg.eigh(cov)
        value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
        keep = value > 1e-12 * dims * np.abs(cov).max()
        for i, x in mine:
            far = [n * a - s for a, s in zip(x, total)]
            z = np.array(far, float) / n @ vector[:, keep] / np.sqrt(value[keep])
            out += [(i, c + 1, n, sum(f * f for f in far), z[c], value[c] / np.trace(cov))
                    for c in range(len(z))]
    return out


def agree(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert np.allclose(np.abs([r[4] for r in got]), np.abs([r[4] for r in want]), rtol=1e-6, atol=1e-7)
    assert all(r[6] <= 1e-4 for r in got)


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = QUERIES["op11_whitening"](spark, SF).collect()
    want = plain([(r["vec_id"], r["embedding"]) for r in table.collect()])
    agree(got, want)
    z = {}
    for r in got:
        z.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    z = np.array([[v[c] for c in range(1, 17)] for v in z.values()])
    assert np.abs(np.cov(z.T, bias=True) - np.eye(16)).max() < 1e-4


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [9, 5, 3, 2, 1]]) for i in range(60)]
    rows += [rows[4], rows[4], (None, rows[5][1]), (100, rows[6][1]), (101, None), (102, []),
             (103, [1.0, None, 2.0, 3.0, 4.0]), (104, [math.nan] * 5), (105, [math.inf] * 5),
             (106, [1e300] * 5), (107, [1.0, 2.0]), (108, [3.0, 5.0]), (109, [4.0, 4.5]), (110, [7.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SHAPE).repartition(3)
    want = plain([r for r in rows if r[0] != 106])
    agree(whitening.whitened(df).collect(), want)
    assert not whitening.whitened(df.limit(0)).collect()
    assert not whitening.whitened(df.where("vec_id > 104 and vec_id < 107")).collect()


def test_few_distinct_rows_have_few_components(spark):
    rows = [(i, [float(i % 3), 1.0, 2.0 * (i % 2), 5.0]) for i in range(50)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SHAPE)
    got = whitening.whitened(df).collect()
    assert {r["component"] for r in got} == {1, 2} and {r["n"] for r in got} == {6}
    agree(got, plain(rows))


def test_large_deviations(spark):
    rows = [(i, [float(v), float(-v)]) for i, v in enumerate([1e6, -3e6, 2e5, 7e15])]
    got = whitening.whitened(spark.createDataFrame([(*r, "x", 1) for r in rows], SHAPE)).collect()
    want = {(r[0], r[1]): r[3] for r in plain(rows)}
    assert {(r["vec_id"], r["component"]): r["deviation"] for r in got} == {
        k: d if d < 2 ** 63 else None for k, d in want.items()}


@pytest.mark.parametrize("values", [
    np.linspace(0.1, 1, 64), np.r_[np.ones(20), np.linspace(0, 0.5, 30)], np.r_[1e6, 1e3, np.ones(9)],
    np.ones(20), np.r_[np.ones(3), np.zeros(20)], np.geomspace(1, 1e-9, 40), np.linspace(1, 2, 150),
    np.array([2.0]), np.r_[1 + 1e-9 * np.arange(30), np.full(10, 0.5)]])
def test_leading_pairs(spark, values):
    q, _ = np.linalg.qr(np.random.default_rng(len(values)).standard_normal((len(values),) * 2))
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    got, vector = feast.leading_pairs(spark, v, 16)
    want = np.linalg.eigvalsh(v)[::-1][:16]
    want = want[want > 1e-12 * len(v) * np.abs(v).max()]
    assert np.allclose(got, want, rtol=0, atol=1e-13 * len(v) * want.max())
    assert np.abs(vector.T @ vector - np.eye(len(got))).max() < 1e-12
    assert np.abs(v @ vector - vector * got).max() < 1e-11 * want.max()
    d, b = feast.tridiagonal(v)
    at = np.sort(np.random.default_rng(1).uniform(values.min() - 1, values.max() + 1, 50))
    full = np.linalg.eigvalsh(v)
    assert feast.count_above(d, b, at).tolist() == [int((full > s).sum()) for s in at]
