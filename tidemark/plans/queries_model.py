"""Features, walk-forward evaluation and recipe comparison."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators import roll as R
from tidemark.plans import recipes as P
from tidemark.plans.queries_roll import FULL
from tidemark.plans.registry import query
from tidemark.session import small
from tidemark.sources import samples as S

KEYS = ["exchange", "symbol"]
V = "PARTITION BY exchange, symbol ORDER BY trade_date"

STEP = f"""{FULL}, px AS (SELECT exchange, symbol, trade_date, ratio_close AS c, volume AS v FROM cont),
 st AS (SELECT *, c / lag(c) OVER w - 1 AS ret, c - lag(c) OVER w AS d FROM px WINDOW w AS ({V}))"""


def full(agg: str, col: str, n: int) -> str:
    frame = f"OVER ({V} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) {frame} = {n} THEN {agg}({col}) {frame} END"


def lagged(n: int) -> str:
    return f"c / lag(c, {n}) OVER ({V}) - 1"


FEATURE_SQL = {
    "ret_1": lagged(1), "ret_5": lagged(5), "ret_20": lagged(20),
    "vol_20": full("stddev_samp", "ret", 20), "vol_60": full("stddev_samp", "ret", 60),
    "mom_10": lagged(10), "mom_60": lagged(60),
    "dist_ma50": f"c / ({full('avg', 'c', 50)}) - 1",
    "dist_ma200": f"c / ({full('avg', 'c', 200)}) - 1",
    "rsi_14": f"100 - 100 / (1 + ({full('avg', 'greatest(d, 0)', 14)}) / "
              f"nullif({full('avg', 'greatest(-d, 0)', 14)}, 0))".replace(
                  "greatest(d, 0)", "CASE WHEN d IS NOT NULL THEN greatest(d, 0) END").replace(
                  "greatest(-d, 0)", "CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END"),
    "vol_ratio": f"({full('stddev_samp', 'ret', 10)}) / ({full('stddev_samp', 'ret', 60)}) - 1",
    "volume_z": f"(v - ({full('avg', 'v', 60)})) / ({full('stddev_samp', 'v', 60)})",
}


def series(spark, sf):
    return R.continuous_series(S.eod(spark, sf))


def _feature_query(key: str, names: list[str]):
    cols = ", ".join(f"round({FEATURE_SQL[n]}, 6) AS {n}" for n in names)

    @query(key, f"{STEP} SELECT symbol, trade_date, {cols} FROM st")
    def run(spark, sf):
        out = X.make_features(series(spark, sf), features=names)
        return out.select("symbol", "trade_date", *[F.round(n, 6).alias(n) for n in names])
    return run


for _key, _names in (
        ("m2_returns", ["ret_1", "ret_5", "ret_20"]), ("m3_volatility", ["vol_20", "vol_60"]),
        ("m4_momentum", ["mom_10", "mom_60"]),
        ("m5_distance_to_mean", ["dist_ma50", "dist_ma200"]), ("m6_rsi", ["rsi_14"]),
        ("m7_vol_ratio", ["vol_ratio"]), ("m8_volume_z", ["volume_z"]),
        ("m1_registry_all", sorted(FEATURE_SQL)),
        ("g11_rolling_deviation", ["vol_20"]), ("g12_rolling_mean", ["dist_ma50"]),
        ("g10_pct_change", ["ret_1", "ret_5"])):
    _feature_query(_key, _names)


DEFAULTS = ", ".join(f"{FEATURE_SQL[n]} AS {n}" for n in X.DEFAULT_FEATURES)
FEATS = f"""{STEP}, ft AS (SELECT exchange, symbol, trade_date, c, v, {DEFAULTS},
  lead(c, 5) OVER ({V}) / c - 1 AS target FROM st)"""
NOT_NULL = " AND ".join(f"{n} IS NOT NULL" for n in [*X.DEFAULT_FEATURES, "target"])


@query("m9_make_features", f"""{FEATS} SELECT symbol, trade_date,
  {', '.join(f'round({n}, 6) AS {n}' for n in X.DEFAULT_FEATURES)}, round(target, 6) AS target
  FROM ft""")
def m9(spark, sf):
    out = X.make_features(series(spark, sf), horizon=5)
    return out.select("symbol", "trade_date", *[
        F.round(n, 6).alias(n) for n in [*X.DEFAULT_FEATURES, "target"]])


@query("g13_forward_target", f"""{FEATS} SELECT symbol, trade_date, round(target, 6) AS target
  FROM ft WHERE target IS NOT NULL""")
def g13(spark, sf):
    out = X.make_features(series(spark, sf), horizon=5, features=["ret_1"])
    return out.where("target IS NOT NULL").select(
        "symbol", "trade_date", F.round("target", 6).alias("target"))


def _corr_sql() -> str:
    cells = [f"SELECT symbol, '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 6) AS corr "
             f"FROM ft GROUP BY symbol"
             for i, a in enumerate(X.DEFAULT_FEATURES) for b in X.DEFAULT_FEATURES[i:]]
    return f"{FEATS} " + " UNION ALL ".join(cells)


@query("a13_feature_correlation", _corr_sql())
def a13(spark, sf):
    feats = X.make_features(series(spark, sf), horizon=5)
    return X.correlation_matrix(feats, X.DEFAULT_FEATURES, ["symbol"]).withColumn(
        "corr", F.round("corr", 6))


ASSIGNED = f"""{FEATS}, num AS (SELECT *, row_number() OVER ({V}) - 1 AS rn,
    count(*) OVER (PARTITION BY exchange, symbol) AS n_rows FROM ft WHERE {NOT_NULL}),
 fb AS (SELECT *, CAST(floor((rn - 250) / 21) AS INTEGER) AS fold,
    CAST(floor((n_rows - 250) / 21) AS INTEGER) AS n_folds FROM num),
 tests AS (SELECT * FROM fb WHERE rn >= 250 AND fold < n_folds)"""


def assigned(spark, sf):
    feats = E.with_params(X.make_features(series(spark, sf), horizon=5), horizon=5)
    return E.assign_folds(feats, X.DEFAULT_FEATURES, KEYS, "trade_date")


@query("g15_fold_assignment", f"SELECT symbol, trade_date, fold, rn::INTEGER AS rn FROM "
       f"({ASSIGNED} SELECT * FROM tests)")
def g15(spark, sf):
    return assigned(spark, sf).where("fold IS NOT NULL").select(
        "symbol", "trade_date", "fold", "rn")


@query("m10_fold_bounds", f"""{ASSIGNED}, b AS (SELECT exchange, symbol, fold, count(*) AS n_test,
    min(trade_date) AS test_start, max(trade_date) AS test_end FROM tests GROUP BY ALL)
  SELECT b.symbol, b.fold, b.n_test, b.test_start, b.test_end, count(*) AS n_train,
         max(n.trade_date) AS train_end
  FROM b JOIN num n ON n.symbol = b.symbol AND n.exchange = b.exchange
    AND n.rn < 250 + b.fold * 21 - 4 GROUP BY ALL""")
def m10(spark, sf):
    return E.fold_bounds(assigned(spark, sf), KEYS, "trade_date").select(
        "symbol", "fold", "n_test", "test_start", "test_end", "n_train", "train_end")


def predictions(spark, sf):
    feats = E.with_params(X.make_features(series(spark, sf), horizon=5), horizon=5)
    return E.walk_forward(feats, X.DEFAULT_FEATURES, keys=KEYS)


@query("m11_fold_coefficients")
def m11(spark, sf):
    rows = assigned(spark, sf)
    return E.fit_folds(rows, X.DEFAULT_FEATURES, KEYS)


@query("m12_predictions")
def m12(spark, sf):
    return predictions(spark, sf)


#: Training sums of a fold: every row before its test block but the last four.
TRAINED = f"""{ASSIGNED}, ends AS (SELECT DISTINCT exchange, symbol, fold FROM tests),
 tr AS (SELECT e.fold, n.* EXCLUDE (fold) FROM ends e JOIN (SELECT *, 0 AS fold FROM num) n
    ON n.exchange = e.exchange AND n.symbol = e.symbol AND n.rn < 250 + e.fold * 21 - 4)"""
TWO = ("ret_5", "vol_20")


@query("m11_two_inputs", f"""{TRAINED}, s AS (SELECT symbol, fold, count(*) AS n, avg(ret_5) AS m1, avg(vol_20) AS m2,
    avg(target) AS my, stddev_pop(ret_5) AS s1, stddev_pop(vol_20) AS s2, covar_pop(ret_5, vol_20) AS c,
    covar_pop(ret_5, target) AS y1, covar_pop(vol_20, target) AS y2 FROM tr GROUP BY symbol, fold),
  z AS (SELECT *, n + 1.0 AS d, n * c / (s1 * s2) AS o, n * y1 / s1 AS b1, n * y2 / s2 AS b2 FROM s),
  w AS (SELECT *, (d * b1 - o * b2) / (d * d - o * o) / s1 AS w1, (d * b2 - o * b1) / (d * d - o * o) / s2 AS w2 FROM z)
  SELECT symbol, fold, round(my - w1 * m1 - w2 * m2, 8) AS intercept, round(w1, 8) AS w1, round(w2, 8) AS w2 FROM w""")
def m11b(spark, sf):
    """Ridge on two inputs, which has a closed form."""
    feats = E.with_params(X.make_features(series(spark, sf), horizon=5), horizon=5)
    rows = E.assign_folds(feats, X.DEFAULT_FEATURES, KEYS, "trade_date")
    beta = lambda i, name: F.round(F.col("beta")[i], 8).alias(name)
    return E.fit_folds(rows, TWO, KEYS).select("symbol", "fold", beta(0, "intercept"), beta(1, "w1"), beta(2, "w2"))


def one_input(spark, sf):
    """Least squares on the last five days' return, every scenario the same rows."""
    feats = E.with_params(X.make_features(series(spark, sf), horizon=5), horizon=5, model="ols")
    return E.walk_forward(feats.dropna(subset=[*X.DEFAULT_FEATURES]), ["ret_5"], keys=KEYS)


OLS = f"""{TRAINED}, fit AS (SELECT symbol, fold, regr_slope(target, ret_5) AS b, regr_intercept(target, ret_5) AS a
    FROM tr GROUP BY symbol, fold),
 pr AS (SELECT t.symbol, t.fold, t.trade_date, t.target AS actual, f.a + f.b * t.ret_5 AS predicted
    FROM tests t JOIN fit f USING (symbol, fold))"""


@query("m12_one_input", f"""{OLS} SELECT symbol, fold, trade_date, round(actual, 8) AS actual,
  round(predicted, 7) AS predicted FROM pr""")
def m12b(spark, sf):
    return one_input(spark, sf).select("symbol", "fold", "trade_date", F.round("actual", 8).alias("actual"),
                                       F.round("predicted", 7).alias("predicted"))


@query("m14_one_input", f"""{OLS}, fo AS (SELECT symbol, fold, count(*) AS n_test,
    sqrt(avg((actual - predicted) * (actual - predicted))) AS m, sqrt(avg(actual * actual)) AS b FROM pr GROUP BY ALL)
  SELECT symbol, count(*) AS folds, round(avg(m), 7) AS model_rmse, round(avg(b), 7) AS baseline_rmse,
    round(avg(1 - m / b), 6) AS skill_vs_baseline, count(*) FILTER (1 - m / b > 0) AS folds_beating_baseline,
    CASE WHEN avg(1 - m / b) > 0 THEN 'beats no-change on average, '
      WHEN count(*) FILTER (1 - m / b > 0) * 2 < count(*) THEN 'does not beat no-change, nor do most folds: '
      ELSE 'does not beat no-change on average, though ' END || count(*) FILTER (1 - m / b > 0) || ' of '
      || count(*) || ' folds' || CASE WHEN avg(1 - m / b) <= 0 AND count(*) FILTER (1 - m / b > 0) * 2 >= count(*)
      THEN ' do' ELSE '' END AS verdict FROM fo GROUP BY symbol""")
def m14b(spark, sf):
    out = E.summarise(E.fold_table(one_input(spark, sf), KEYS), KEYS)
    return out.select("symbol", "folds", F.round("model_rmse", 7).alias("model_rmse"),
                      F.round("baseline_rmse", 7).alias("baseline_rmse"),
                      F.round("skill_vs_baseline", 6).alias("skill_vs_baseline"), "folds_beating_baseline", "verdict")


@query("m13_baseline", f"""{ASSIGNED} SELECT symbol, fold, round(sqrt(avg(target * target)), 7)
    AS baseline_rmse, 0.5::DOUBLE AS baseline_dir_acc FROM tests GROUP BY symbol, fold""")
def m13(spark, sf):
    rows = assigned(spark, sf).where("fold IS NOT NULL").select(
        *KEYS, "fold", F.col("target").alias("actual"), F.lit(0.0).alias("predicted"))
    return E.fold_table(rows, KEYS).select(
        "symbol", "fold", F.round("baseline_rmse", 7).alias("baseline_rmse"), "baseline_dir_acc")


#: A momentum forecast both engines can compute, to check the error measures themselves.
NAIVE = f"""{ASSIGNED}, pr AS (SELECT exchange, symbol, fold, target AS a, ret_5 AS p FROM tests),
 fo AS (SELECT symbol, fold, count(*) AS n_test, sqrt(avg((a - p) * (a - p))) AS model_rmse,
    sqrt(avg(a * a)) AS baseline_rmse,
    coalesce(avg(CASE WHEN a <> 0 THEN CASE WHEN sign(a) = sign(p) THEN 1.0 ELSE 0.0 END END), 0.5)
      AS model_dir_acc FROM pr GROUP BY symbol, fold),
 sk AS (SELECT *, 1 - model_rmse / baseline_rmse AS skill FROM fo)"""


def naive(spark, sf):
    rows = assigned(spark, sf).where("fold IS NOT NULL").select(
        *KEYS, "fold", F.col("target").alias("actual"), F.col("ret_5").alias("predicted"))
    return E.fold_table(rows, KEYS)


@query("a12_error_measures", f"""{NAIVE} SELECT symbol, fold, n_test, round(model_rmse, 7) AS model_rmse,
  round(model_dir_acc, 7) AS model_dir_acc, round(skill, 7) AS skill FROM sk""")
def a12(spark, sf):
    return naive(spark, sf).select("symbol", "fold", "n_test", *[
        F.round(c, 7).alias(c) for c in ("model_rmse", "model_dir_acc", "skill")])


@query("a11_fold_summary", f"""{NAIVE} SELECT symbol, count(*) AS folds,
  round(avg(model_rmse), 7) AS model_rmse, round(avg(skill), 7) AS skill_vs_baseline,
  round(avg(model_dir_acc), 7) AS model_dir_acc, count(*) FILTER (skill > 0) AS folds_beating_baseline
  FROM sk GROUP BY symbol""")
def a11(spark, sf):
    out = E.summarise(naive(spark, sf), KEYS)
    return out.select("symbol", "folds", *[
        F.round(c, 7).alias(c) for c in ("model_rmse", "skill_vs_baseline", "model_dir_acc")],
        "folds_beating_baseline")


@query("m14_fold_table")
def m14(spark, sf):
    return E.fold_table(predictions(spark, sf), KEYS)


@query("o2_skill_distribution", f"""{NAIVE} SELECT symbol, CAST(floor(skill * 20) AS BIGINT) AS bin,
  count(*) AS folds, count(*) FILTER (skill > 0) AS beating, any_value(mean_skill) AS mean_skill
  FROM sk JOIN (SELECT symbol, round(avg(skill), 7) AS mean_skill FROM sk GROUP BY symbol) USING (symbol)
  GROUP BY symbol, bin""")
def o2(spark, sf):
    """Bins of the skill with the folds that beat the baseline, and the mean of the series beside them."""
    folds = naive(spark, sf)
    mean = folds.groupBy("symbol").agg(F.round(F.avg("skill"), 7).alias("mean_skill"))
    return folds.groupBy("symbol", F.floor(F.col("skill") * 20).alias("bin")).agg(
        F.count(F.lit(1)).alias("folds"), F.count_if(F.col("skill") > 0).alias("beating")).join(mean, "symbol")


@query("m15_recipe_scenarios")
def m15(spark, sf):
    """Feature rows per scenario once its overrides are applied."""
    prices = series(spark, sf)
    return P.scenario_features(prices, P.SAMPLE).groupBy("symbol", "scenario").agg(
        F.count(F.lit(1)).alias("rows"), F.count("target").alias("labelled"))


@query("m16_scenario_comparison")
def m16(spark, sf):
    return P.run_recipe(series(spark, sf), P.SAMPLE)


#: Three naive scenarios: the return of so many days is the forecast, over all series.
FORECASTS = ("ret_1", "ret_5", "mom_10")
RANKED = f"""{ASSIGNED}, sc AS (SELECT scenario, exchange, symbol, fold, target AS a, p FROM tests
    UNPIVOT (p FOR scenario IN ({", ".join(FORECASTS)}))),
 fo AS (SELECT scenario, symbol, fold, 1 - sqrt(avg((a - p) * (a - p))) / sqrt(avg(a * a)) AS skill
    FROM sc GROUP BY ALL),
 agg AS (SELECT scenario, count(*) AS folds, avg(skill) AS skill_vs_baseline,
    count(*) FILTER (skill > 0) AS folds_beating_baseline FROM fo GROUP BY scenario)"""


def scenarios(spark, sf):
    rows = assigned(spark, sf).where("fold IS NOT NULL")
    stacked = F.explode(F.array(*[F.struct(F.lit(f).alias("scenario"), F.col(f).alias("predicted")) for f in FORECASTS]))
    frame = rows.select(*KEYS, "fold", F.col("target").alias("actual"), stacked.alias("s")).select(
        "*", "s.scenario", "s.predicted")
    return E.summarise(E.fold_table(frame, [*KEYS, "scenario"]), ["scenario"])


@query("h4_scenario_ranking", f"""{RANKED} SELECT scenario, folds, folds_beating_baseline,
  round(skill_vs_baseline, 7) AS skill_vs_baseline,
  row_number() OVER (ORDER BY skill_vs_baseline DESC NULLS LAST, scenario) AS place FROM agg""")
def h4(spark, sf):
    out = P.with_place(P.comparison_table(scenarios(spark, sf)))
    return out.select("scenario", "folds", "folds_beating_baseline", F.round("skill_vs_baseline", 7).alias(
        "skill_vs_baseline"), F.col("place").cast("bigint").alias("place"))


@query("h8_best_scenario", f"""{RANKED} SELECT arg_max(scenario, skill_vs_baseline) AS scenario,
  round(max(skill_vs_baseline), 7) AS skill_vs_baseline FROM agg""")
def h8(spark, sf):
    best = P.best(scenarios(spark, sf), ["scenario", "verdict"])
    return best.select("scenario", F.round("skill_vs_baseline", 7).alias("skill_vs_baseline"))


@query("j16_membership", """SELECT event_id, event_type FROM events WHERE event_type IN (
  SELECT event_type FROM events GROUP BY event_type HAVING max(value) > 350)""")
def j16(spark, sf):
    e = S.table(spark, sf, "events")
    wanted = e.groupBy("event_type").agg(F.max("value").alias("v")).where("v > 350")
    return e.join(small(wanted.select("event_type")), "event_type", "left_semi").select(
        "event_id", "event_type")
