"""Recipes: a declared input, features, estimator and validation, with named variations.

Every scenario of a recipe runs on the same prices in one job; the scenario is a
column next to the symbol and the fold.
"""
from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators.contract import union_frames

#: What a recipe may leave out (fixed values).
DEFAULTS = {"target.horizon_days": 1, "features": X.DEFAULT_FEATURES, "estimator.kind": "ridge",
            "estimator.alpha": 1.0, "validation.min_train": 250, "validation.test_size": 21}


def dotted(blocks: dict) -> dict:
    """Nested settings under dotted names: a scenario then overlays single settings, lists whole."""
    return {".".join(path): value for block, content in blocks.items() for path, value in (
        [((block, name), v) for name, v in content.items()] if isinstance(content, dict)
        else [((block,), content)])}


@dataclass(frozen=True)
class Recipe:
    """Settings by dotted name, and what each scenario sets differently."""

    name: str
    version: str = "0"
    settings: dict = field(default_factory=dict)
    scenarios: dict[str, dict] = field(default_factory=lambda: {"baseline": {}})

    @classmethod
    def from_dict(cls, raw: dict) -> Recipe:
        own = dotted(raw)
        changes = {s["name"]: dotted(s.get("overrides") or {}) for s in own.pop("scenarios", [])}
        return cls(own.pop("recipe.name", "recipe"), str(own.pop("recipe.version", "0")), own,
                   changes or {"baseline": {}})

    @classmethod
    def from_json(cls, text: str) -> Recipe:
        return cls.from_dict(json.loads(text))

    def settings_of(self, scenario: str) -> dict:
        return DEFAULTS | self.settings | self.scenarios[scenario]

    def chosen(self, names: Sequence[str] | None) -> dict[str, dict]:
        """Settings of the named scenarios, of all if none are named."""
        return {s: self.settings_of(s) for s in self.scenarios if not names or s in names}


#: The sample recipe and its variations (fixed values).
SAMPLE = Recipe(
    "daily_return", "1.0",
    {"input.adjust": "ratio", "input.roll_method": "volume", "target.kind": "forward_return"},
    {"baseline": {},
     "longer_horizon": {"target.horizon_days": 5},
     "more_features": {"features": ["ret_1", "ret_5", "ret_20", "vol_20", "vol_60", "mom_10",
                                    "mom_60", "dist_ma50", "dist_ma200", "rsi_14", "vol_ratio"]},
     "price_only": {"features": ["ret_1", "ret_5", "ret_20"]},
     "stronger_penalty": {"estimator.alpha": 25.0},
     "shorter_history": {"validation.min_train": 125}})


def scenario_features(prices: DataFrame, recipe: Recipe,
                      scenarios: Sequence[str] | None = None) -> DataFrame:
    """Feature rows of every scenario; inputs a scenario does not use are zero."""
    chosen = recipe.chosen(scenarios)
    every = sorted({f for settings in chosen.values() for f in settings["features"]})
    frames = []
    for name, settings in chosen.items():
        horizon, used = int(settings["target.horizon_days"]), settings["features"]
        feats = X.make_features(prices, horizon=horizon, features=used).dropna(subset=used)
        feats = feats.withColumns({f: F.lit(0.0) for f in every if f not in used})
        feats = feats.withColumns({
            "scenario": F.lit(name), "horizon_days": F.lit(horizon),
            "n_features": F.lit(len(used)),
            "used": F.array(*[F.lit(f in used) for f in every])})
        frames.append(E.with_params(
            feats, min_train=int(settings["validation.min_train"]),
            test_size=int(settings["validation.test_size"]), horizon=horizon,
            alpha=float(settings["estimator.alpha"]), model=settings["estimator.kind"]))
    return union_frames(frames)


def run_recipe(prices: DataFrame, recipe: Recipe, *, scenarios: Sequence[str] | None = None,
               keys: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    """Skill of every scenario on the same input, per symbol."""
    chosen = recipe.chosen(scenarios)
    cols = sorted({f for settings in chosen.values() for f in settings["features"]})
    by = [*keys, "scenario"]
    folds = E.fold_table(E.walk_forward(scenario_features(prices, recipe, scenarios), cols,
                                        keys=by), by)
    table = {s: F.struct(F.lit(int(p["target.horizon_days"])).alias("horizon_days"),
                         F.lit(len(p["features"])).alias("n_features"),
                         F.lit(float(p["estimator.alpha"])).alias("alpha"),
                         F.lit(int(p["validation.min_train"])).alias("min_train"))
             for s, p in chosen.items()}
    known = F.create_map(*(x for s, row in table.items() for x in (F.lit(s), row)))
    return E.summarise(folds, by).withColumn(
        "run_id", F.concat_ws(":", F.lit(recipe.name), F.lit(recipe.version), *by)).withColumn(
        "_set", F.try_element_at(known, F.col("scenario"))).select("*", "_set.*").drop("_set")


#: Columns of a comparison, best first (fixed values).
COMPARED = ["scenario", "horizon_days", "n_features", "alpha", "folds", "skill_vs_baseline",
            "model_dir_acc", "folds_beating_baseline", "run_id"]


def comparison_table(results: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    present = [c for c in (*extra, *COMPARED) if c in results.columns]
    return results.select(*present).orderBy(F.desc_nulls_last("skill_vs_baseline"))


def with_place(results: DataFrame) -> DataFrame:
    """Place of each row; results hold one row per scenario, so one ordered pass is enough."""
    return results.withColumn("place", F.row_number().over(
        Window.orderBy(F.desc_nulls_last("skill_vs_baseline"), "scenario")))


def best(results: DataFrame, columns: Sequence[str] = ("scenario", "verdict")) -> DataFrame:
    return results.agg(*[F.max_by(c, "skill_vs_baseline").alias(c) for c in columns],
                       F.max("skill_vs_baseline").alias("skill_vs_baseline"))
