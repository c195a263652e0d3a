"""Digests, runs that pin their data, stored reference data and the calendar of a source."""
import hashlib
import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_jobs import CONTRACT
from tidemark.operators import calendar as K
from tidemark.operators import evaluate as E
from tidemark.operators import monitor as M
from tidemark.operators import roll as R
from tidemark.operators import versions as V
from tidemark.plans import ingest as G
from tidemark.plans import recipes as P
from tidemark.plans import reference, runs
from tidemark.sources import snapshots

EOD = G.C.Contract.from_dict({
    "dataset": "eod", "schema_version": "1", "grain": ["symbol", "trade_date"], "event_time_column": "trade_date",
    "columns": [{"name": "symbol", "type": "string", "required": True},
                {"name": "trade_date", "type": "date", "required": True}]})
CAL = K.TradingCalendar("c", "Asia/Kolkata", holidays={"2026-10-02": "Feast"})


def prices(spark, n=330, bump=0.0):
    rows = [("X", s, date(2025, 1, 1) + timedelta(days=i), 100 + (i * 37 % 91) / 7 + k + bump * (i == 5), 5.0)
            for k, s in enumerate("AB") for i in range(n)]
    return spark.createDataFrame(rows, "exchange string, symbol string, trade_date date, adj_close double, volume double")


def test_digest_of_digests(spark):
    rows = sorted((r["trade_date"], r["adj_close"]) for r in prices(spark).where("symbol = 'A'").collect())
    months = {}
    for day, value in rows:
        months.setdefault((day.year, day.month), []).append(f"{day}:{round(value * 10 ** 6)}")
    want = hashlib.sha256("\n".join(hashlib.sha256("\n".join(m).encode()).hexdigest()
                                    for _, m in sorted(months.items())).encode()).hexdigest()
    got = {r["symbol"]: r for r in R.fingerprint(prices(spark).repartition(7)).collect()}
    assert got["A"]["series_sha"] == want != got["B"]["series_sha"]
    assert (got["A"]["rows"], got["A"]["last_date"]) == (330, rows[-1][0])
    assert R.fingerprint(prices(spark, bump=1.0)).where("symbol = 'A'").first()["series_sha"] != want


def test_runs_are_read_back_and_replaced(spark, tmp_path):
    root = str(tmp_path)
    recipe = P.Recipe("r", "2", {"features": ["ret_1", "ret_5"], "validation.min_train": 100},
                      {"baseline": {}, "ols": {"estimator.kind": "ols"}})
    first = {r["run_id"]: r.asDict() for r in runs.run_pinned(
        prices(spark), recipe, root, started="2026-01-01", finished="2026-01-02").collect()}
    assert set(first) == {f"r.2.X.{s}.{n}" for s in "AB" for n in ("baseline", "ols")}
    again = {r["run_id"]: r.asDict() for r in runs.run_pinned(
        prices(spark, bump=9.0), recipe, root, started="2026-01-01", finished="2026-01-02").collect()}
    assert set(again) == set(first)
    assert json.loads(again["r.2.X.A.ols"]["params"])["fingerprint"] != json.loads(
        first["r.2.X.A.ols"]["params"])["fingerprint"]
    one = runs.load_artifact(spark, root, "predictions", "r.2.X.A.ols")
    assert one.select("trade_date").distinct().count() == one.count() > 0
    folds = runs.load_artifact(spark, root, "folds", "r.2.X.A.ols").count()
    assert json.loads(again["r.2.X.A.ols"]["metrics"])["folds"] == folds
    assert again["r.2.X.A.ols"]["data_through"] == date(2025, 1, 1) + timedelta(days=329)


def test_stacked_solves_with_odd_folds():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    rows, want = [], []
    for k in range(6):
        x = rng.normal(size=(40, 3)) * [1, 5, 0.1] + [3, -2, 0]
        y = x @ [1.0, -0.3, 2.0] + rng.normal(size=40)
        used = [True, k % 2 == 0, True]
        x[:, 1] = x[:, 1] if used[1] else 0.0
        model, alpha = ("ridge", 2.0) if k < 3 else ("ols", 1.0)
        g = x.T @ x
        rows.append((40.0, y.sum(), list(x.sum(0)), list(x.T @ y), [g[i, j] for i in range(3) for j in range(i, 3)],
                     used, alpha, model))
        z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
        z = z[:, used]
        b = np.linalg.solve(z.T @ z + (alpha * np.eye(z.shape[1]) if model == "ridge" else 0), z.T @ (y - y.mean()))
        w = np.zeros(3)
        w[used] = b / x.std(0)[used]
        want.append([y.mean() - w @ x.mean(0), *w])
    names = ["n", "sy", "sx", "sxy", "sxx", "used", "alpha", "model"]
    assert np.allclose(E._solve(pd.DataFrame(rows, columns=names), 3), want)
    flat = pd.DataFrame([(5.0, 10.0, [5.0, 5.0], [10.0, 10.0], [5.0, 5.0, 5.0], [True, True], 1.0, "ols")], columns=names)
    assert np.allclose(E._solve(flat, 2), [[2.0, 0.0, 0.0]])


def chosen(spark, rows):
    return spark.createDataFrame([("X", "S", date(2025, 12, 30) + timedelta(days=d), date(2026, m, 28)) for d, m in rows],
                                 "exchange string, symbol string, trade_date date, expiry date")


def beliefs(spark, root):
    return sorted((str(r["trade_date"]), r["expiry"].month, str(r["known_from"]), str(r["known_to"]))
                  for r in reference.stored_map(spark, root).collect())


def test_the_stored_map(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    first = chosen(spark, [(0, 1), (1, 1), (2, 1), (3, 2)])
    assert reference.refresh(spark, root, first, today="2026-02-01", run_id="a")["opened"] == 4
    second = chosen(spark, [(0, 1), (1, 1), (2, 2), (3, 2)])
    with monkeypatch.context() as m:
        m.setattr(snapshots, "publish", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            reference.refresh(spark, root, second, today="2026-03-01", run_id="b")
    assert len(beliefs(spark, root)) == 4
    for _ in range(2):
        counts = reference.refresh(spark, root, second, today="2026-03-01", run_id="b")
    assert counts == {"opened": 0, "closed": 0, "unchanged": 0}
    assert beliefs(spark, root)[2:] == [
        ("2026-01-01", 1, "2026-02-01", "2026-02-28"), ("2026-01-01", 2, "2026-03-01", V.OPEN_END),
        ("2026-01-02", 2, "2026-02-01", V.OPEN_END)]
    state = snapshots.manifest(spark, f"{root}/contract_reference")
    assert state["parts"]["2025"] == snapshots.manifest(spark, f"{root}/contract_reference", 1)["parts"]["2025"]
    third = chosen(spark, [(0, 1), (1, 1), (2, 3), (3, 2)])
    counts = reference.refresh(spark, root, third, today="2026-03-01", run_id="c")
    assert counts == {"opened": 1, "closed": 1, "unchanged": 3}
    believed = V.known_on(reference.stored_map(spark, root), "2026-03-01").where("trade_date = '2026-01-01'")
    assert [r["expiry"].month for r in believed.collect()] == [3]


def test_the_stored_specs(spark, tmp_path):
    old = {"lot_size": 50, "tick_size": 1, "known_from": "2010-01-01", "known_to": "2019-12-31"}
    new = {"lot_size": 100, "tick_size": 1, "known_from": "2020-01-01", "known_to": V.OPEN_END}
    for run, raw in (("a", {"X": {"S": [old]}}), ("b", {"X": {"S": [old, new], "T": []}}), ("a", {})):
        reference.load_specs(spark, str(tmp_path), raw, run_id=run)
    facts = spark.createDataFrame([("X", "S", date(d, 6, 1), 2.0, 1.0) for d in (2015, 2021)],
                                  "exchange string, symbol string, trade_date date, price double, lots double")
    specs = reference.stored_specs(spark, str(tmp_path))
    assert sorted(r["notional"] for r in V.notional(facts, specs).collect()) == [100.0, 200.0]
    with pytest.raises(Exception, match="lot size unknown"):
        V.notional(facts.withColumn("symbol", F.lit("U")), specs).collect()


def test_a_source_finds_its_calendar(spark, tmp_path):
    raw = {"name": "eod", "load": {"table": "eod"}, "acquire": {"monitor": {"calendar": "c", "lookback_days": 4}},
           "quality": {"checks": ["contract", "freshness", "expected_coverage"]}}
    with pytest.raises(KeyError):
        G.Source.from_dict(raw, EOD)
    source = G.Source.from_dict(raw, EOD, {"c": CAL})
    week = [date(2026, 9, d) for d in (24, 25, 28, 29, 30)] + [date(2026, 10, 1)]

    def load(days, run):
        rows = spark.createDataFrame([("S", str(d)) for d in days], "symbol string, trade_date string")
        return G.run_source(spark, source, rows, str(tmp_path), now="2026-10-05 12:00:00", run_id=run)

    # The second is a feast, the third and fourth a weekend, the fifth not due before the evening.
    assert load(week, "whole")["published"]
    assert load(week[:-1], "old")["blocked_by"] == ["freshness"]
    assert load(week[:2] + week[3:], "hole")["blocked_by"] == ["expected_coverage"]
    assert G.Source("s", CONTRACT, "t").due_days(spark, "2026-10-05") is None


def test_skip_reasons(spark):
    days = spark.createDataFrame([(date(2026, 10, d),) for d in range(1, 11)], "day date")
    loaded = spark.createDataFrame([(date(2026, 10, 1), 7), (date(2026, 10, 5), 4)], "day date, rows long")
    table = K.classify(days, CAL, CAL.holiday_frame(spark))
    got = {r["day"].day: (r["outcome"], r["rows"]) for r in M.backfill_report(
        table, loaded, CAL, "2026-10-06 20:00:00").collect()}
    late = "not published yet, due 23:55"
    assert got == {1: ("fetched", 7), 2: ("holiday: Feast", None), 3: ("weekend", None), 4: ("weekend", None),
                   5: ("fetched", 4), 6: ("nothing published", None), 7: (late, None), 8: ("in the future", None),
                   9: ("in the future", None), 10: ("in the future", None)}
