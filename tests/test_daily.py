"""Roll, gate, checks, versions, features and evaluation on hand-made frames."""
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar as K
from tidemark.operators import checks as Q
from tidemark.operators import contract as C
from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators import monitor as M
from tidemark.operators import roll as R
from tidemark.operators import versions as V

NEAR, FAR = date(2026, 1, 28), date(2026, 2, 25)
EOD = ("exchange string, symbol string, expiry date, trade_date date, close double, volume double, "
       "open_interest double, ingested_at timestamp_ntz")


def eod(spark, rows):
    """(day, expiry, close, volume) rows."""
    return spark.createDataFrame(
        [("X", "S", e, d, float(c), float(v), 1.0) for d, e, c, v in rows],
        EOD.rsplit(",", 1)[0]).withColumn(
        "ingested_at", F.date_add("trade_date", 1).cast("timestamp_ntz"))


def days(n, start=date(2026, 1, 5)):
    out, d = [], start
    while len(out) < n:
        if d.weekday() < 5:
            out.append(d)
        d += timedelta(days=1)
    return out


def dark(overlap=True):
    """The old contract stops on day 10 without meeting the new one unless they overlap."""
    rows = []
    for i, d in enumerate(days(20)):
        if i < 10:
            rows.append((d, NEAR, 100 + i * 0.1, 1000))
        if i >= (9 if overlap else 10):
            rows.append((d, FAR, 200 + i * 0.2, 100 if i < 10 else 1000))
    return rows


def test_splice_uses_the_last_shared_day(spark):
    out = R.continuous_series(eod(spark, dark())).orderBy("trade_date").collect()
    rolls = [r for r in out if r["is_roll"]]
    assert len(rolls) == 1 and rolls[0]["roll_adjusted"]
    i = out.index(rolls[0])
    assert abs(out[i - 1]["adj_close"] - 201.8) < 1e-9


def test_roll_without_a_shared_day_is_flagged(spark):
    out = R.continuous_series(eod(spark, dark(False))).collect()
    flags = [r["roll_adjusted"] for r in out if r["roll_adjusted"] is not None]
    assert flags == [False]
    assert all(r["adj_close"] == r["close"] for r in out)


def test_map_never_rolls_back_and_gap_day_is_absent(spark):
    d = days(5, date(2026, 3, 2))
    apr, may = date(2026, 4, 28), date(2026, 5, 28)
    rows = [(x, apr, 100, 900 if i == 0 else 10) for i, x in enumerate(d)]
    rows += [(x, may, 101, 500) for i, x in enumerate(d) if i != 3]
    frame = eod(spark, rows)
    chosen = [r["expiry"] for r in R.front_month_map(frame).orderBy("trade_date").collect()]
    assert chosen == sorted(chosen)
    assert R.continuous_series(frame).count() == 4


def test_unadjusted_series_has_no_flags(spark):
    out = R.continuous_series(eod(spark, dark()), adjust="none")
    assert out.where("roll_adjusted IS NOT NULL").isEmpty()


def test_refresh_restates_nothing_then_opens_and_closes_one(spark):
    frame = eod(spark, dark())
    chosen = R.front_month_map(frame)
    first = V.first_map(chosen, today="2026-03-01")
    assert V.refresh_counts(chosen, first).first()[:] == (0, 0, 20)
    day = days(20)[9]
    fixed = frame.withColumn("volume", F.when(
        (F.col("trade_date") == F.lit(day)) & (F.col("expiry") == F.lit(FAR)), 5000.0)
        .otherwise(F.col("volume")))
    again = V.refresh_map(R.front_month_map(fixed), first, today="2026-04-01")
    beliefs = again.where(F.col("trade_date") == F.lit(day)).orderBy("known_from").collect()
    assert [(b["expiry"], b["known_to"]) for b in beliefs] == [
        (NEAR, date(2026, 3, 31)), (FAR, date(2999, 12, 31))]
    assert V.known_on(again, "2026-03-15").where(F.col("trade_date") == F.lit(day)).first()[
        "expiry"] == NEAR


def test_point_in_time_specs_and_refusal(spark):
    specs = V.spec_rows(spark, {"X": {"S": [
        {"lot_size": 50, "tick_size": 1, "known_from": "2015-01-01", "known_to": "2019-12-31"},
        {"lot_size": 100, "tick_size": 1, "known_from": "2020-01-01", "known_to": "2999-12-31"}]}})
    facts = spark.createDataFrame([("X", "S", d, 10.0, 2.0) for d in (
        date(2019, 12, 31), date(2020, 1, 1))],
        "exchange string, symbol string, trade_date date, price double, lots double")
    got = V.notional(facts, specs).orderBy("trade_date").collect()
    assert [r["notional"] for r in got] == [1000.0, 2000.0]
    with pytest.raises(Exception, match="lot size unknown"):
        V.notional(facts.withColumn("symbol", F.lit("Q")), specs).collect()


# ---- gate ---------------------------------------------------------------------------
def contract(**rules):
    return C.Contract.from_dict({
        "dataset": "t", "schema_version": "1.0", "grain": ["symbol", "trade_id"],
        "event_time_column": "ts", "columns": [
            {"name": "symbol", "type": "string", "required": True},
            {"name": "trade_id", "type": "int", "required": True, "min": 1},
            {"name": "ts", "type": "timestamp_ms", "required": True},
            {"name": "price", "type": "float", "required": True, "min": 0, "exclusive_min": True}],
        "rules": rules})


def bulk(spark, nulls=0, zeros=0):
    return spark.range(1, 1001).selectExpr(
        "'S' AS symbol", "id AS trade_id", "1767600000000 + id AS ts",
        f"CASE WHEN id <= {nulls} THEN NULL WHEN id <= {nulls + zeros} THEN 0D ELSE 5D END AS price",
        "id AS seen")


def gated(df, **rules):
    return C.gate(df, contract(**rules), now="2026-02-01", arrival=["seen"])


def test_null_budget_blocks_and_zero_prices_only_warn(spark):
    blocked = gated(bulk(spark, nulls=951), max_null_fraction=0.0)
    assert Q.check_contract(blocked.verdict()).first()["status"] == "fail"
    warned = gated(bulk(spark, zeros=3), max_null_fraction=0.0)
    row = Q.check_contract(warned.verdict()).first()
    assert row["status"] == "warn" and row["rows_out"] == 997


def test_replays_collapse_to_the_first_and_are_counted(spark):
    rows = bulk(spark).where("trade_id = 1")
    g = gated(rows.unionByName(rows.withColumn("seen", F.lit(9))).unionByName(rows))
    v = g.verdict().first()
    assert (v["clean"], v["duplicates"], v["rejected"]) == (1, 2, 0)


def test_missing_column_and_broken_rule_are_reported(spark):
    g = gated(bulk(spark).drop("price"))
    assert not g.shape_ok and g.failures()[0]["kind"] == "missing_column"
    g = gated(bulk(spark), cross_field=[{"name": "bad", "expr": "nosuch > 1"}])
    assert "rule_error" in [f["kind"] for f in g.failures()]


def test_null_makes_a_cross_field_rule_fail(spark):
    g = gated(bulk(spark, nulls=1), cross_field=[{"name": "p", "expr": "(price > 1) & (price < 9)"}])
    assert {r["rule"]: r["rows"] for r in g.rule_counts().collect()}[
        "cross-field rule failed: p"] == 1


def test_integers_are_exact_and_fractions_rejected(spark):
    df = spark.createDataFrame([("9007199254740993", 0), ("7.0", 1), ("7.5", 2), ("x", 3)],
                               "v string, i int")
    got = [r[0] for r in df.select("i", C.coerce(F.col("v"), "int", "string").alias("v"))
           .orderBy("i").select("v").collect()]
    assert got == [9007199254740993, 7, None, None]


def test_schema_gate_fails_closed(spark):
    assert Q.schema_version_status("1", None, "d")[::2] == ("pass", True)
    assert Q.schema_version_status("1", None, "d", readable=False)[0] == "fail"
    known = spark.createDataFrame([("d", "1", 1)], "dataset string, schema_version string, first_seen int")
    assert Q.schema_version_status("1", known, "d")[::2] == ("pass", False)
    assert Q.schema_version_status("2", known, "d")[0] == "fail"
    assert Q.schema_version_status("2", known, "d", accept=True)[::2] == ("pass", True)


def file_of(spark, drop=lambda d, s: False):
    rows = [(d, s, 1.0) for d in days(20) for s in "ABCDE" if not drop(d, s)]
    return spark.createDataFrame(rows, "trade_date date, symbol string, volume double")


def weekdays(spark, df):
    none = spark.createDataFrame([], "day date, holiday string")
    return K.classify(K.day_spine(df, "trade_date"), K.TradingCalendar(), none)


def test_coverage_catches_truncation_and_a_missing_day(spark):
    whole = file_of(spark)
    cal = weekdays(spark, whole)
    last, middle = days(20)[-1], days(20)[7]
    assert Q.check_coverage(whole, cal).first()["status"] == "pass"
    cut = file_of(spark, lambda d, s: d == last and s in "CDE")
    assert Q.check_coverage(cut, cal).first()["status"] == "fail"
    holed = file_of(spark, lambda d, s: d == middle)
    assert Q.check_coverage(holed, cal).first()["status"] == "fail"
    assert [r["day"] for r in Q.missing_days(holed, cal).collect()] == [middle]


def test_gaps_tell_partial_from_nothing(spark):
    empty, part = days(20)[4], days(20)[5:8]
    df = file_of(spark, lambda d, s: d == empty or (d in part and s == "B"))
    due = weekdays(spark, file_of(spark)).where("is_trading_day").select("day")
    got = {r["day"]: (r["kind"], r["missing_symbols"]) for r in M.gaps(
        due, df, K.TradingCalendar(), list("ABCDE")).collect()}
    assert got[empty] == ("nothing", list("ABCDE"))
    assert all(got[d] == ("partial", ["B"]) for d in part) and len(got) == 4


def test_arrival_window(spark):
    cal = K.TradingCalendar("c", "Asia/Kolkata")
    d = days(4)
    calendar = spark.createDataFrame([(x, x != d[3]) for x in d], "day date, is_trading_day boolean")
    seen = spark.createDataFrame(
        [(d[0], f"{d[0]} 18:30:00"), (d[1], f"{d[1]} 19:10:00")], "day date, t string").selectExpr(
        "day", "cast(t AS timestamp_ntz) AS available_at")
    got = {r["day"]: r for r in M.arrival_status(calendar, seen, cal).collect()}
    assert [got[x]["status"] for x in d] == ["on_time", "late", "missing", "skipped"]
    assert got[d[0]]["attempts"] == 2 and got[d[2]]["attempts"] == 9


def test_sessions_over_midnight_and_closed_days(spark):
    cal = K.TradingCalendar("c", "Asia/Kolkata", session_open="18:00", session_close="02:00")
    none = spark.createDataFrame([], "day date, holiday string")
    spine = spark.createDataFrame([(date(2026, 1, 1) + timedelta(i),) for i in range(12)], "day date")
    events = spark.createDataFrame(
        [(1, "2026-01-05 20:00:00"), (2, "2026-01-05 21:00:00"), (3, "2026-01-10 15:00:00"),
         (4, "2026-01-05 12:30:00")], "id int, t string").selectExpr(
        "id", "cast(t AS timestamp_ntz) AS ts")
    got = {r["id"]: r["session_date"] for r in K.with_session(
        events, K.classify(spine, cal, none), cal).collect()}
    assert got == {1: date(2026, 1, 5), 2: None, 3: None, 4: date(2026, 1, 5)}


# ---- features and evaluation ----------------------------------------------------------
def path(spark, n=400, seed=7):
    rng = np.random.default_rng(seed)
    px = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, n)))
    rows = [("X", "S", date(2020, 1, 1) + timedelta(i), float(p), float(rng.integers(1, 99)))
            for i, p in enumerate(px)]
    return spark.createDataFrame(
        rows, "exchange string, symbol string, trade_date date, adj_close double, volume double")


def test_tampering_with_the_future_leaves_features_alone(spark):
    px = path(spark)
    cut = date(2020, 1, 1) + timedelta(200)
    tampered = px.withColumn("adj_close", F.when(F.col("trade_date") > F.lit(cut), 1.0)
                             .otherwise(F.col("adj_close")))
    names = sorted(X.FEATURES)

    def upto(df, cols):
        return X.make_features(df, features=names).where(F.col("trade_date") <= F.lit(cut)).select(
            "trade_date", *cols)

    assert upto(px, names).exceptAll(upto(tampered, names)).isEmpty()
    moved = upto(px, ["target"]).exceptAll(upto(tampered, ["target"])).collect()
    assert [r["trade_date"] for r in moved] == [cut]


def test_unknown_feature_raises(spark):
    with pytest.raises(X.UnknownFeature):
        X.make_features(path(spark, 10), features=["nope"])


@pytest.mark.parametrize("model,horizon", [("ridge", 5), ("ols", 1)])
def test_walk_forward_equals_a_direct_loop(spark, model, horizon):
    cols = ["ret_1", "vol_20", "rsi_14"]
    feats = X.make_features(path(spark), features=cols, horizon=horizon)
    params = E.with_params(feats, min_train=150, test_size=30, horizon=horizon, model=model)
    got = {r["trade_date"]: (r["fold"], r["predicted"])
           for r in E.walk_forward(params, cols).collect()}
    pdf = feats.orderBy("trade_date").toPandas().dropna(subset=[*cols, "target"])
    x, y, when = pdf[cols].to_numpy(), pdf["target"].to_numpy(), list(pdf["trade_date"])
    start, fold, want = 150, 0, {}
    while start + 30 <= len(x):
        xt, yt = x[:start - (horizon - 1)], y[:start - (horizon - 1)]
        mu, sd = xt.mean(0), xt.std(0)
        z = np.column_stack([np.ones(len(xt)), (xt - mu) / sd])
        pen = np.eye(4) * (1.0 if model == "ridge" else 0.0)
        pen[0, 0] = 0
        b = np.linalg.solve(z.T @ z + pen, z.T @ yt)
        for i in range(start, start + 30):
            want[when[i]] = (fold, float(np.r_[1, (x[i] - mu) / sd] @ b))
        start, fold = start + 30, fold + 1
    assert got.keys() == want.keys() and fold > 3
    assert all(got[d][0] == want[d][0] and abs(got[d][1] - want[d][1]) < 1e-9 for d in want)


def test_last_training_label_resolves_before_the_test_block(spark):
    feats = E.with_params(X.make_features(path(spark), features=["ret_1"], horizon=5),
                          min_train=150, test_size=30, horizon=5)
    rows = E.assign_folds(feats, ["ret_1"], ["exchange", "symbol"], "trade_date")
    for b in E.fold_bounds(rows, ["exchange", "symbol"], "trade_date").collect():
        assert (b["test_start"] - b["train_end"]).days == 5
