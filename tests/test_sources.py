"""Drops, configuration, ledger, alert names and calendars."""
import hashlib
import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts as L
from tidemark.operators import calendar as K
from tidemark.operators import deliveries as D
from tidemark.plans import config
from tidemark.plans import recipes as P
from tidemark.sources import drops, landing

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_drops_by_suffix(spark, tmp_path):
    df = spark.createDataFrame([("1.5", "a"), ("x", "b")], "Close string, Symbol string")
    for kind in ("parquet", "csv", "json"):
        path = str(tmp_path / f"d.{kind}")
        (df.write.option("header", "true") if kind == "csv" else df.write).format(kind).save(path)
        got = drops.map_columns(drops.read_drop(spark, path), {"Close": "close", "Symbol": "symbol"},
                                {"exchange": "X"})
        assert sorted(r["close"] for r in got.collect()) == ["1.5", "x"]
        assert set(got.columns) == {"close", "symbol", "exchange"}
    with pytest.raises(ValueError):
        drops.read_drop(spark, "x.xlsx")


def test_day_slice_keeps_a_file_without_the_day(spark):
    df = spark.createDataFrame([(date(2026, 1, 5),), (date(2026, 1, 6),)], "d date")
    assert drops.day_slice(df, "d", "2026-01-06").count() == 1
    assert drops.day_slice(df, "d", "2026-02-06").count() == 0
    assert drops.day_slice(df, "d", "2026-02-06", whole_if_absent=True).count() == 2


def test_quarantine_of_nothing_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "a string")
    assert landing.write_quarantine(empty, str(tmp_path), "t", when="2026-01-01") is None
    assert list(tmp_path.iterdir()) == []


def test_same_content_under_a_new_name_is_settled(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,1\n")
    (tmp_path / "b.csv").write_text("x,1\n")
    (tmp_path / "c.csv").write_text("y,2\n")
    (tmp_path / ".part.csv").write_text("z\n")
    files = D.fingerprints(D.settled_files(spark, str(tmp_path), "*.csv", now="2190-01-01"))
    prints = {r["path"].rsplit("/", 1)[1]: r["fingerprint"] for r in files.collect()}
    assert prints["a.csv"] == prints["b.csv"] != prints["c.csv"] and len(prints) == 3
    ledger = spark.createDataFrame([(prints["a.csv"], True), (prints["c.csv"], False)],
                                   "fingerprint string, ok boolean")
    assert [r["fingerprint"] for r in D.waiting(files, ledger).collect()] == [prints["c.csv"]]
    spent = ledger.unionByName(ledger.where("NOT ok")).unionByName(ledger.where("NOT ok"))
    assert D.waiting(files, spent).isEmpty()
    assert prints["c.csv"] == hashlib.sha256(b"y,2\n").hexdigest()


def test_alert_names(spark):
    gaps = spark.createDataFrame([("nothing", "2026-01-02"), ("partial", "2026-01-05")],
                                 "kind string, day string")
    assert [(r["alert"], r["incident"]) for r in L.gap_alerts(gaps, "src").collect()] == [
        ("DeliveryMissing", "2026-01-02"), ("DeliveryIncomplete", "2026-01-05")]


def test_a_scenario_changes_only_what_it_names():
    recipe = P.Recipe.from_dict({
        "recipe": {"name": "r", "version": 2}, "target": {"kind": "k", "horizon_days": 1},
        "features": ["ret_1"], "scenarios": [
            {"name": "base"}, {"name": "far", "overrides": {"target": {"horizon_days": 5}}},
            {"name": "wide", "overrides": {"features": ["ret_1", "vol_ratio"]}}]})
    assert recipe.version == "2" and recipe.settings_of("base")["target.horizon_days"] == 1
    assert recipe.settings_of("far") == recipe.settings_of("base") | {"target.horizon_days": 5}
    assert recipe.settings_of("wide")["features"] == ["ret_1", "vol_ratio"]


def test_configuration_files(tmp_path):
    contract = {"dataset": "d", "grain": ["id"], "event_time_column": "ts",
                "columns": [{"name": "id", "type": "int", "required": True}]}
    source = {"name": "s", "load": {"table": "t"}, "acquire": {"incremental": {"enabled": True}},
              "quality": {"checks": ["contract", "freshness"], "freshness_sla_seconds": 120}}
    cal = {"timezone": "Asia/Kolkata", "trading_days": ["mon"], "session": {"open": "10:00"},
           "holidays_2026": [{"date": "2026-01-26", "name": "H"}]}
    for name, raw in (("c", contract), ("s", source), ("k", cal)):
        (tmp_path / f"{name}.json").write_text(json.dumps(raw))
    got = config.source(tmp_path / "s.json", tmp_path / "c.json")
    assert got.incremental and got.sla_seconds == 120 and got.contract.required == ["id"]
    assert config.calendar(tmp_path / "k.json").holidays == {"2026-01-26": "H"}


def test_calendar_reasons_and_due_days(spark):
    cal = K.TradingCalendar("c", "Asia/Kolkata", holidays={"2026-10-02": "Feast"})
    closed = cal.holiday_frame(spark)
    days = spark.createDataFrame([(date(2026, 10, d),) for d in range(1, 6)], "day date")
    why = {r["day"].day: r["why_closed"] for r in K.classify(days, cal, closed).collect()}
    assert why == {1: None, 2: "holiday: Feast", 3: "weekend", 4: "weekend", 5: None}
    due = K.expected_days(spark, cal, closed, now="2026-10-05 18:54:00", lookback=4)
    assert [r["day"].day for r in due.collect()] == [1]
    due = K.expected_days(spark, cal, closed, now="2026-10-05 18:56:00", lookback=4)
    assert sorted(r["day"].day for r in due.collect()) == [1, 5]


def test_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    import pytest
    from tidemark.session import shared_root

    conf = SimpleNamespace(get=lambda *_: None, set=lambda *_: None)
    unset = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master="yarn", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(
        getCheckpointDir=lambda: unset)))
    with pytest.raises(RuntimeError):
        shared_root(SimpleNamespace(conf=conf, sparkContext=context))


def test_a_row_without_version_stays_if_it_is_alone(spark):
    from tidemark.operators.bars import latest_per_grain

    df = spark.sql("SELECT * FROM VALUES ('a', 1.0, NULL), ('b', 2.0, NULL), "
                   "('b', 3.0, timestamp_ntz'2026-01-01') AS t(k, v, ingested_at)")
    got = {r["k"]: r["v"] for r in latest_per_grain(df, ["k"], version="ingested_at").collect()}
    assert got == {"a": 1.0, "b": 3.0}


def test_first_arrival_prefers_dated_copies(spark):
    from tidemark.operators.checks import latest_by

    df = spark.sql("SELECT * FROM VALUES ('a', 1, NULL), ('a', 2, 5), ('b', 3, NULL) AS t(k, v, o)")
    assert {r["k"]: r["v"] for r in latest_by(df, ["k"], "o").collect()} == {"a": 2, "b": 3}


def test_a_session_without_a_named_folder(tmp_path):
    """Stages and scratch tables work where nothing names a checkpoint folder, and go when discarded."""
    import subprocess
    import sys

    code = """
import os, tempfile
tempfile.tempdir = None
from pyspark.sql import functions as F
from tidemark.session import build_session, discard, shared_root, written
from tidemark.operators.asof import asof_join
spark = build_session("bare", "local[2]", 2, **{"spark.ui.enabled": "false"})
assert spark.conf.get("spark.checkpoint.dir", None) is None
root = shared_root(spark)
assert root == shared_root(spark)
table = written(spark.range(5), "t")
assert table.count() == 5
discard(table)
kept = root.split(":", 1)[-1]
assert not [n for n in os.listdir(kept) if n.startswith("t-")]
t = spark.sql("SELECT 'v' venue, 's' symbol, 1L trade_id, timestamp_ntz'2026-01-01' ts, 5.0D price")
q = spark.sql("SELECT 'v' venue, 's' symbol, timestamp_ntz'2026-01-02' query_ts")
assert asof_join(q, t).first()["price"] == 5.0
print("done")
"""
    conf = tmp_path / "conf"
    conf.mkdir()
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_SUBMIT"))}
    env |= {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": f"{REPO}:{env.get('PYTHONPATH', '')}"}
    ran = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert ran.stdout.strip().endswith("done"), ran.stderr[-2000:]


def test_equal_versions_give_one_row_whatever_the_order(spark):
    from tidemark.operators.bars import latest_per_grain

    rows = [("a", float(i), "2026-01-01", f"n{i}") for i in range(40)] + [("a", 99.0, "2025-01-01", "old")]
    df = spark.createDataFrame(rows, "k string, v double, at string, note string").withColumn(
        "ingested_at", F.col("at").cast("timestamp_ntz"))
    got = {tuple(latest_per_grain(df.orderBy(F.rand(seed)).repartition(seed + 1), ["k"]).first()) for seed in range(4)}
    assert len(got) == 1 and (row := got.pop())[1] != 99.0 and row[3] == f"n{int(row[1])}"
    numbers = latest_per_grain(df.select(F.xxhash64("k").alias("k"), "v", "ingested_at"), ["k"])
    assert "SortAggregate" not in numbers._jdf.queryExecution().executedPlan().toString()
