"""As-of joins, staleness, trailing windows and bars on frames small enough to check by eye."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof as A
from tidemark.operators import bars as B
from tidemark.operators import trailing as T

T0 = datetime(2026, 1, 5, 10, 0, 0)
TRADE = ("venue string, symbol string, trade_id bigint, ts timestamp_ntz, price double, qty double, "
         "ingested_at timestamp_ntz")


def trades(spark, prints, symbol="S"):
    rows = [("v", symbol, i + 1, T0 + timedelta(seconds=s), float(p), 1.0, T0)
            for i, (s, p) in enumerate(prints)]
    return spark.createDataFrame(rows, TRADE)


def asks(spark, seconds, symbol="S"):
    return spark.createDataFrame(
        [("v", symbol, T0 + timedelta(seconds=s)) for s in seconds],
        "venue string, symbol string, query_ts timestamp_ntz")


def answers(df):
    return {(r["query_ts"] - T0).total_seconds(): r["price"] for r in df.collect()}


PLANS = pytest.mark.parametrize("few", [None, False])


@PLANS
def test_at_or_before(spark, few):
    t = trades(spark, [(0, 100), (10, 101), (20, 102)])
    got = answers(A.asof_join(asks(spark, [5, 10, 19, -1]), t, few_decisions=few))
    assert got == {5: 100, 10: 101, 19: 101, -1: None}


@PLANS
def test_strict_differs_only_at_the_trade_time(spark, few):
    t = trades(spark, [(0, 100), (10, 101), (20, 102)])
    got = answers(A.asof_join(asks(spark, [5, 10, 19]), t, strict=True, few_decisions=few))
    assert got == {5: 100, 10: 100, 19: 101}


@PLANS
def test_a_later_print_changes_nothing(spark, few):
    q = asks(spark, [30])
    before = trades(spark, [(0, 100), (10, 101)])
    after = trades(spark, [(0, 100), (10, 101), (30.2, 999)])
    assert answers(A.asof_join(q, before, few_decisions=few)) == answers(
        A.asof_join(q, after, few_decisions=few))


@PLANS
def test_match_is_carried_over_empty_days(spark, few):
    t = trades(spark, [(0, 100)])
    got = answers(A.asof_join(asks(spark, [3 * 86400 + 7]), t, few_decisions=few))
    assert got == {3 * 86400 + 7: 100}


@PLANS
def test_ties_take_the_highest_id_and_slice_edges_hold(spark, few):
    t = trades(spark, [(60, 1), (60, 2), (119.999999, 3), (120, 4)])
    q = asks(spark, [60, 119.999999, 120, 119])
    assert answers(A.asof_join(q, t, few_decisions=few)) == {
        60: 2, 119.999999: 3, 120: 4, 119: 2}
    assert answers(A.asof_join(q, t, strict=True, few_decisions=few)) == {
        60: None, 119.999999: 2, 120: 3, 119: 2}


def test_crowded_slices_use_the_plan_for_many(spark):
    t = trades(spark, [(i / 100, i) for i in range(500)])
    q = asks(spark, [i / 100 + 0.005 for i in range(300)])
    assert A._few(q.selectExpr("venue", "symbol", "unix_micros(cast(query_ts AS timestamp)) AS _t"),
                  ["venue", "symbol"]) is None
    got = answers(A.asof_join(q, t))
    assert all(got[round(i / 100 + 0.005, 6)] == i for i in range(300))


def test_one_hot_key_is_exact_in_both_plans(spark):
    rows = spark.range(6000).selectExpr(
        "'v' AS venue", "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE concat('K', id % 50) END AS symbol",
        "id AS trade_id",
        "cast(timestamp_micros(1767600000000000 + (id * 7919 % 6000) * 91000000) AS timestamp_ntz) AS ts",
        "cast(id AS double) AS price")
    q = rows.where("trade_id % 11 = 0").selectExpr(
        "venue", "symbol", "ts + INTERVAL 3 SECONDS AS query_ts").distinct()
    few, many = A.asof_join(q, rows), A.asof_join(q, rows, few_decisions=False)
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
    brute = {r["k"]: r["p"] for r in q.alias("q").join(
        rows.alias("t"), "symbol").where("t.ts <= q.query_ts").groupBy("symbol", "query_ts")
        .agg({"ts": "max"}).selectExpr("concat(symbol, query_ts) AS k", "`max(ts)` AS p").collect()}
    got = {r["k"]: r["p"] for r in few.where("trade_ts IS NOT NULL").selectExpr(
        "concat(symbol, query_ts) AS k", "trade_ts AS p").collect()}
    assert got == brute


def test_stale_price_is_nulled_and_kept(spark):
    m = A.with_staleness(A.asof_join(asks(spark, [2400, -5]), trades(spark, [(0, 100)])))
    rows = {(r["query_ts"] - T0).total_seconds(): r for r in m.collect()}
    assert rows[2400]["price"] is None and rows[2400]["staleness_seconds"] == 2400
    assert rows[2400]["stale"] and rows[2400]["trade_ts"] == T0
    assert rows[-5]["stale"] and rows[-5]["price"] is None


def minute_bars(spark, n=40):
    return B.ohlcv(trades(spark, [(60 * i + 1, 100 + i % 7) for i in range(n)]), "1m",
                   deduplicated=True)


def test_window_holds_closed_bars_only(spark):
    returns = T.bar_returns(minute_bars(spark))
    out = T.attach_trailing(asks(spark, [1200, 1217.5]), returns, window_minutes=10)
    counts = {(r["query_ts"] - T0).total_seconds(): r["bars_in_window"] for r in out.collect()}
    assert counts == {1200: 10, 1217.5: 9}


def test_same_answer_alone_as_in_a_batch(spark):
    returns = T.bar_returns(minute_bars(spark))
    alone = T.attach_trailing(asks(spark, [1217.5]), returns, window_minutes=10).collect()
    batch = T.attach_trailing(asks(spark, [300, 1217.5, 2000]), returns, window_minutes=10)
    assert alone[0] in batch.collect()


def test_a_bar_still_open_does_not_enter(spark):
    q = asks(spark, [1217.5])
    calm = minute_bars(spark, 20)
    shock = calm.unionByName(minute_bars(spark, 21).where("bucket = timestamp_ntz'2026-01-05 10:20:00'")
                             .selectExpr("venue", "symbol", "bucket", "open", "high", "low",
                                         "close * 50 AS close", "volume", "trades", "notional"))
    a = T.attach_trailing(q, T.bar_returns(calm), window_minutes=10).first()
    b = T.attach_trailing(q, T.bar_returns(shock), window_minutes=10).first()
    c = T.attach_trailing(q, T.bar_returns(shock), window_minutes=10, contaminated=True).first()
    assert a["realised_vol"] == b["realised_vol"] and c["realised_vol"] > 10 * b["realised_vol"]


def test_partial_bucket_is_dropped_and_grid_kept(spark):
    t = trades(spark, [(30 * i, i) for i in range(40)])
    bars = B.ohlcv(t, "5m", "2026-01-05 10:02:30", "2026-01-05 10:15:00").orderBy("bucket").collect()
    assert [b["bucket"].minute for b in bars] == [5, 10]
    assert all(b["trades"] == 10 for b in bars)


def test_volume_and_trades_add_up_after_replays(spark):
    t = trades(spark, [(17 * i, i) for i in range(200)])
    bars = B.ohlcv(t.unionByName(t.where("trade_id % 3 = 0")), "15m")
    assert bars.groupBy().sum("volume", "trades").first()[:] == (200.0, 200)


def test_correction_beats_the_original_and_needs_a_version(spark):
    t = trades(spark, [(0, 100)])
    fixed = t.selectExpr("venue", "symbol", "trade_id", "ts", "price * 2 AS price", "qty",
                         "ingested_at + INTERVAL 1 DAY AS ingested_at")
    assert B.dedup_trades(t.unionByName(fixed)).first()["price"] == 200
    with pytest.raises(B.MissingVersion):
        B.dedup_trades(t.drop("ingested_at"))
    with pytest.raises(B.MissingVersion):
        B.latest_per_grain(t.selectExpr("symbol", "price", "cast(null AS timestamp) AS ingested_at"),
                           ["symbol"], check_nulls=True)


def test_trade_range_filter_reaches_the_scan(spark, tmp_path):
    trades(spark, [(0, 1)]).write.parquet(str(tmp_path / "t"))
    bars = B.ohlcv(spark.read.parquet(str(tmp_path / "t")), "5m", "2026-01-05 10:00:00",
                   "2026-01-05 11:00:00")
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


@pytest.mark.parametrize("prune", [False, True])
def test_null_keys_match_nothing_in_any_plan(spark, prune):
    t = trades(spark, [(1, 10)]).union(trades(spark, [(2, 20)], None))
    q = asks(spark, [5]).union(asks(spark, [6], None))
    for few in (None, False):
        assert answers(A.asof_join(q, t, few_decisions=few, prune_keys=prune)) == {5: 10.0, 6: None}


@PLANS
def test_replays_and_corrections_need_no_deduplication(spark, few):
    t = trades(spark, [(10, 100), (20, 200), (30, 300)])
    fixed = t.where("price = 200").withColumn("price", F.lit(9.0)).withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY"))
    undated = t.where("price = 300").withColumn("price", F.lit(7.0)).withColumn(
        "ingested_at", F.lit(None).cast("timestamp_ntz"))
    every = t.unionByName(fixed).unionByName(t).unionByName(undated)
    q = asks(spark, [9, 10, 25, 31])
    got = answers(A.asof_join(q, every, version="ingested_at", few_decisions=few))
    assert got == {9: None, 10: 100, 25: 9, 31: 300}


def test_exact_quantiles(spark):
    import random

    import numpy as np
    from tidemark.functions.quantiles import exact_quantile

    rng = random.Random(1)
    rows = [("hot", rng.lognormvariate(0, 3)) for _ in range(5000)] + [("same", 2.5)] * 40
    rows += [("one", 7.0), ("two", 1.0), ("two", 4.0), ("none", None), ("nan", float("nan")), (None, 3.0)]
    rows += [("far", 10.0 ** rng.randint(-200, 200)) for _ in range(301)] + [("ties", float(i % 3)) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for q in (0.5, 0.0, 1.0, 0.37):
        want = {k: float(np.quantile([v for j, v in rows if j == k], q))
                for k in ("hot", "same", "one", "two", "far", "ties")}
        got = {r["k"]: r["quantile"] for r in exact_quantile(df, ["k"], "v", q).collect()}
        assert {k: got[k] for k in want} == pytest.approx(want, rel=1e-12)
        assert set(got) - set(want) <= {None}


@pytest.mark.parametrize("contaminated", [False, True])
def test_trailing_windows_against_brute_force(spark, contaminated):
    import random
    import statistics

    from tidemark.operators import trailing as T

    rng = random.Random(4)
    bars = sorted(rng.sample(range(-40, 200), 150))
    rets = {b: None if rng.random() < 0.05 else rng.uniform(-1, 1) * 10 ** rng.randint(-3, 3) for b in bars}
    returns = spark.createDataFrame([(b, r) for b, r in rets.items()], "b long, ret double").selectExpr(
        "'v' AS venue", "'S' AS symbol", "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, 0, b * 60) AS bucket", "ret")
    at = [60 * rng.randint(-30, 210) + rng.choice([0, 0, 17.5, 59]) for _ in range(120)]
    asked = spark.createDataFrame([(float(a),) for a in set(at)], "s double").selectExpr(
        "'v' AS venue", "'S' AS symbol", "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, 0, s) AS query_ts", "s")
    for window in (1, 10, 37):
        got = T.attach_trailing(asked, returns, window_minutes=window, contaminated=contaminated).collect()
        for r in got:
            seen = [b for b in bars if 60 * b >= r["s"] - 60 * window and (
                60 * b < r["s"] if contaminated else 60 * b + 60 <= r["s"])]
            values = [rets[b] for b in seen if rets[b] is not None]
            assert r["bars_in_window"] == len(seen)
            assert r["realised_vol"] == (pytest.approx(statistics.stdev(values), rel=1e-9) if len(values) > 1 else None)
