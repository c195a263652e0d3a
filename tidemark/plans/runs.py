"""Run registry rows and artifacts."""
from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.times import instant
from tidemark.operators import evaluate as E
from tidemark.operators.roll import fingerprint
from tidemark.plans.recipes import Recipe, scenario_features
from tidemark.session import written


def run_rows(results: DataFrame, params: dict, *, model: str, data_through, started, finished,
             code_version: str = "", key: str = "scenario") -> DataFrame:
    """One registry row per result row; parameters and metrics as JSON text with sorted keys."""
    skip = {key, "run_id", "verdict"}
    metrics = sorted(c for c, kind in results.dtypes if c not in skip and kind in (
        "double", "bigint", "int"))
    return results.select(
        "run_id", F.concat(F.lit(f"{model}:"), F.col(key)).alias("model"),
        F.lit(json.dumps(params, sort_keys=True, default=str)).alias("params"),
        F.lit(code_version).alias("code_version"),
        (instant(data_through) if isinstance(data_through, str) else data_through)
        .alias("data_through"),
        F.to_json(F.struct(*metrics)).alias("metrics"),
        instant(started).alias("started_at"), instant(finished).alias("finished_at"))


def save_artifacts(root: str, **frames: DataFrame) -> dict[str, str]:
    """Predictions, folds and the like, by run; a run that is repeated replaces its own rows."""
    paths = {}
    for name, df in frames.items():
        paths[name] = f"{root}/artifacts/{name}"
        df.hint("rebalance", "run_id").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(paths[name])
    return paths


def load_artifact(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{root}/artifacts/{name}")
    return df.where(F.col("run_id") == run_id) if run_id else df


def run_pinned(prices: DataFrame, recipe: Recipe, root: str, *, started, finished,
               scenarios: Sequence[str] | None = None, pinned: str = "adj_close",
               keys: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    """Every scenario on one stored input: predictions, folds and a registry row for each run.

    A registry row holds its scenario's settings and the digest, row count and last day of the series it
    saw, so that a later run can tell whether it saw the same data. Runs are named by recipe,
    version, series and scenario.
    """
    spark, by = prices.sparkSession, [*keys, "scenario"]
    stored = written(prices, "pinned")
    pins = fingerprint(stored, pinned).select(*keys, "rows", "last_date", "series_sha")
    run_id = F.concat_ws(".", F.lit(recipe.name), F.lit(recipe.version), *by).alias("run_id")
    chosen = recipe.chosen(scenarios)
    cols = sorted({f for settings in chosen.values() for f in settings["features"]})
    found = E.walk_forward(scenario_features(stored, recipe, scenarios), cols, keys=by)
    save_artifacts(root, predictions=found.select("*", run_id))
    predictions = load_artifact(spark, root, "predictions")
    save_artifacts(root, folds=E.fold_table(predictions, [*by, "run_id"]))
    results = E.summarise(load_artifact(spark, root, "folds"), [*by, "run_id"]).join(pins, list(keys))
    settings = F.create_map(*(x for s, p in chosen.items() for x in (F.lit(s), F.lit(json.dumps(p, sort_keys=True)))))
    params = F.to_json(F.struct(F.col("series_sha").alias("fingerprint"), F.col("rows").alias("input_rows"),
                                F.try_element_at(settings, F.col("scenario")).alias("settings")))
    metrics = ["folds", "folds_beating_baseline", "baseline_rmse", "model_dir_acc", "model_rmse", "skill_vs_baseline"]
    registry = results.select(
        *by, "run_id", F.concat(F.lit(f"{recipe.name}:"), F.col("scenario")).alias("model"), params.alias("params"),
        F.col("last_date").alias("data_through"), F.to_json(F.struct(*sorted(metrics))).alias("metrics"), "verdict",
        instant(started).alias("started_at"), instant(finished).alias("finished_at"))
    save_artifacts(root, registry=registry)
    return load_artifact(spark, root, "registry")
