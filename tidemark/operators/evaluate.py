"""Walk-forward evaluation as sums of products.

A fold trains on every row before its test block, so consecutive folds differ by one
block. Each block is reduced to its sufficient statistics, a running sum over blocks
gives every fold's Gram matrix, and only the p-by-p solve runs in Python, one row per
fold. Series, scenario and fold are columns; nothing loops on the driver.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import written

PARAMS = ("min_train", "test_size", "gap", "alpha", "model")


def with_params(df: DataFrame, *, min_train: int = 250, test_size: int = 21,
                horizon: int = 1, purge: int | None = None, alpha: float = 1.0,
                model: str = "ridge") -> DataFrame:
    """Evaluation settings as columns; the purge gap defaults to horizon - 1 rows."""
    gap = max(horizon - 1, 0) if purge is None else max(purge, 0)
    return df.withColumns({
        "min_train": F.lit(int(min_train)), "test_size": F.lit(int(test_size)),
        "gap": F.lit(int(gap)), "alpha": F.lit(float(alpha)), "model": F.lit(model)})


def assign_folds(df: DataFrame, cols: Sequence[str], keys: Sequence[str],
                 time: str, centred: Sequence[str] = ()) -> DataFrame:
    """Row number, the fold a row is tested in and the first fold it trains.

    ``centred`` inputs are shifted by their mean in the series: same fit, less cancellation in
    the sums. Numbers, counts and means come from one window.

    Only complete test blocks exist, and none when the series is shorter than one
    training window plus one block.
    """
    full = df.dropna(subset=[*cols, "target"])
    order = Window.partitionBy(*keys).orderBy(time)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rn = F.row_number().over(order) - 1
    kept = [c for c in full.columns if c not in centred]
    out = full.select(*kept, *[(F.col(c) - F.avg(c).over(whole)).alias(c) for c in centred], rn.alias("rn"),
                      F.count(F.lit(1)).over(whole).alias("n_rows"))
    blocks = F.floor((F.col("n_rows") - F.col("min_train")) / F.col("test_size"))
    block = F.floor((F.col("rn") - F.col("min_train")) / F.col("test_size"))
    first = F.ceil((F.col("rn") + 1 - (F.col("min_train") - F.col("gap"))) / F.col("test_size"))
    return out.select(
        "*", blocks.cast("int").alias("n_folds"),
        F.when((F.col("rn") >= F.col("min_train")) & (block < blocks), block).cast("int")
        .alias("fold"),
        F.when(F.col("rn") == 0, 0).otherwise(F.greatest(first, F.lit(0))).cast("int")
        .alias("segment")).where("n_folds > 0")


def fold_bounds(assigned: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Per fold: training rows and end, test rows, start and end."""
    running = (
        Window.partitionBy(*keys).orderBy("fold")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    trained = (
        assigned.where("segment < n_folds").groupBy(*keys, F.col("segment").alias("fold"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(time).alias("t"))
        .select(*keys, "fold", F.sum("n").over(running).alias("n_train"),
                F.max("t").over(running).alias("train_end")))
    tested = assigned.where("fold IS NOT NULL").groupBy(*keys, "fold").agg(
        F.count(F.lit(1)).alias("n_test"), F.min(time).alias("test_start"),
        F.max(time).alias("test_end"))
    return tested.join(trained, [*keys, "fold"])


def _solve(rows: pd.DataFrame, p: int) -> np.ndarray:
    """Intercept and weights of every row at once: (row, 1 + p).

    The Gram matrices of a batch are one (row, p, p) array. An unused input has the identity's
    row in it, so its weight is zero.
    """
    stack = lambda name: np.array(rows[name].tolist(), float).reshape(len(rows), -1)
    n, sy = rows["n"].to_numpy(float)[:, None], rows["sy"].to_numpy(float)[:, None]
    mean = stack("sx") / n
    upper = np.triu_indices(p)
    gram = np.zeros((len(rows), p, p))
    gram[:, *upper] = stack("sxx")
    gram = gram + np.triu(gram, 1).transpose(0, 2, 1)
    spread = np.sqrt(np.maximum(np.diagonal(gram, axis1=1, axis2=2) / n - mean ** 2, 0.0))
    spread = np.where(spread <= 1e-12 * np.maximum(np.abs(mean), 1e-300), 1.0, spread)
    cov = (gram - n[:, :, None] * mean[:, :, None] * mean[:, None, :]) / (spread[:, :, None] * spread[:, None, :])
    side = (stack("sxy") - mean * sy) / spread
    used = np.array(rows["used"].tolist(), bool).reshape(len(rows), p)
    both = used[:, :, None] & used[:, None, :]
    ridge = np.where(rows["model"].to_numpy() == "ridge", rows["alpha"].to_numpy(float), 0.0)
    cov = np.where(both, cov, 0.0) + np.eye(p) * np.where(used, ridge[:, None], 1.0)[:, None, :]
    side = np.where(used, side, 0.0)[:, :, None]
    try:
        beta = np.linalg.solve(cov, side)
    except np.linalg.LinAlgError:
        beta = np.linalg.pinv(cov, hermitian=True) @ side
    weights = beta[:, :, 0] / spread
    return np.hstack([sy / n - (weights * mean).sum(axis=1, keepdims=True), weights])


def fit_folds(assigned: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One coefficient array per (keys, fold)."""
    p = len(cols)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    x = [F.col(c) for c in cols]
    used = F.col("used") if "used" in assigned.columns else F.array(*[F.lit(True)] * p)
    sums: dict[str, Column] = {"n": F.count(F.lit(1)).cast("double"), "sy": F.sum("target")}
    sums |= {f"sx{i}": F.sum(x[i]) for i in range(p)}
    sums |= {f"sxy{i}": F.sum(x[i] * F.col("target")) for i in range(p)}
    sums |= {f"sxx{i}_{j}": F.sum(x[i] * x[j]) for i, j in pairs}
    fixed = {"used": F.first(used), "alpha": F.first("alpha"), "model": F.first("model")}
    blocks = assigned.where("segment < n_folds").groupBy(
        *keys, F.col("segment").alias("fold")).agg(
        *[c.alias(n) for n, c in (sums | fixed).items()])
    running = (
        Window.partitionBy(*keys).orderBy("fold")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = blocks.select(*keys, "fold", *fixed,
                           *[F.sum(n).over(running).alias(n) for n in sums])
    packed = totals.select(
        *keys, "fold", *fixed, "n", "sy", F.array(*[f"sx{i}" for i in range(p)]).alias("sx"),
        F.array(*[f"sxy{i}" for i in range(p)]).alias("sxy"),
        F.array(*[f"sxx{i}_{j}" for i, j in pairs]).alias("sxx"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[*keys, "fold"]].assign(beta=list(_solve(batch, p)))

    kinds = dict(packed.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in (*keys, "fold")) + ", beta array<double>"
    return packed.mapInPandas(solve, schema)


def predict(assigned: DataFrame, betas: DataFrame, cols: Sequence[str],
            keys: Sequence[str], time: str) -> DataFrame:
    tests = assigned.where("fold IS NOT NULL").join(betas, [*keys, "fold"])
    score = F.col("beta")[0]
    for i, c in enumerate(cols):
        score = score + F.col("beta")[i + 1] * F.col(c)
    return tests.select(*keys, "fold", time, F.col("target").alias("actual"),
                        score.alias("predicted"))


def walk_forward(features: DataFrame, cols: Sequence[str], *,
                 keys: Sequence[str] = ("exchange", "symbol"),
                 time: str = "trade_date") -> DataFrame:
    """Out-of-sample predictions of every complete fold.

    ``features`` carries the settings of :func:`with_params` as columns. Series are
    daily, so one has a bounded number of rows. The numbered rows are stored: they are fitted and
    predicted, and the features behind them are dear.
    """
    assigned = written(assign_folds(features, cols, keys, time, centred=cols), "folds")
    return predict(assigned, fit_folds(assigned, cols, keys), cols, keys, time)


def hit_rate(actual: Column, predicted: Column) -> Column:
    """Share of non-zero moves whose direction was called; one half when there are none."""
    right = F.when(actual != 0, (F.signum(actual) == F.signum(predicted)).cast("double"))
    return F.coalesce(F.avg(right), F.lit(0.5))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((actual - predicted) * (actual - predicted)))


def fold_table(predictions: DataFrame, keys: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    """Errors per fold against the no-change forecast, whose hit rate is one half by convention."""
    a, p = F.col("actual"), F.col("predicted")
    scored = predictions.groupBy(*keys, "fold").agg(
        F.count(F.lit(1)).alias("n_test"), rmse(a, p).alias("model_rmse"),
        rmse(a, F.lit(0.0)).alias("baseline_rmse"), hit_rate(a, p).alias("model_dir_acc"))
    skill = F.when(F.col("baseline_rmse") == 0, 0.0).otherwise(
        1 - F.try_divide(F.col("model_rmse"), F.col("baseline_rmse")))
    return scored.withColumns({"baseline_dir_acc": F.lit(0.5), "skill": skill})


def summarise(folds: DataFrame, keys: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    beat = F.count_if(F.col("skill") > 0)
    out = folds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("folds"), F.avg("model_rmse").alias("model_rmse"),
        F.avg("baseline_rmse").alias("baseline_rmse"),
        F.avg("skill").alias("skill_vs_baseline"), F.avg("model_dir_acc").alias("model_dir_acc"),
        F.avg("baseline_dir_acc").alias("baseline_dir_acc"),
        beat.alias("folds_beating_baseline"))
    return out.withColumn("verdict", verdict())


def verdict() -> Column:
    """A sentence that does not claim more than the folds show."""
    share = F.format_string("%d of %d folds", "folds_beating_baseline", "folds")
    return F.when(
        F.col("skill_vs_baseline") > 0,
        F.concat(F.lit("beats no-change on average, "), share),
    ).when(
        F.col("folds_beating_baseline") * 2 < F.col("folds"),
        F.concat(F.lit("does not beat no-change, nor do most folds: "), share),
    ).otherwise(F.concat(F.lit("does not beat no-change on average, though "), share,
                         F.lit(" do")))
