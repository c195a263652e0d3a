"""Loads, restores, entitlement and the serving surface end to end."""
import pytest
from pyspark.sql import functions as F

from tidemark.operators import contract as C
from tidemark.operators import entitlements as N
from tidemark.plans import ingest as G
from tidemark.plans.serve import MarketData
from tidemark.sources import snapshots
from tests.test_daily import dark, eod
from tests.test_intraday import asks, trades

NOW = "2026-01-06 00:00:00"
CONTRACT = C.Contract.from_dict({
    "dataset": "ticks", "schema_version": "1.0", "grain": ["venue", "symbol", "trade_id"],
    "event_time_column": "ts", "columns": [
        {"name": "venue", "type": "string", "required": True},
        {"name": "symbol", "type": "string", "required": True},
        {"name": "trade_id", "type": "int", "required": True},
        {"name": "ts", "type": "timestamp_ms", "required": True},
        {"name": "price", "type": "float", "required": True, "min": 0, "exclusive_min": True},
        {"name": "qty", "type": "float", "required": True}],
    "rules": {"max_null_fraction": 0.0}})
SOURCE = G.Source("ticks", CONTRACT, "trades", checks=("contract", "uniqueness"), incremental=True)


def raw(spark, n=50):
    return trades(spark, [(i, 100 + i) for i in range(n)]).drop("ingested_at")


def load(spark, rows, root, run, **kw):
    return G.run_source(spark, SOURCE, rows, root, now=NOW, run_id=run, **kw)


def test_load_replay_block_and_restore(spark, tmp_path):
    root = str(tmp_path)
    first = load(spark, raw(spark), root, "a", window_end="2026-01-05 10:00:20")
    assert first["published"] and first["rows_loaded"] == 50
    cursor = G.logged(spark, root, "ingest_cursors").first()
    assert str(cursor["position_ts"]) == "2026-01-05 10:00:20"

    load(spark, raw(spark, 60), root, "b")
    assert snapshots.read(spark, f"{root}/trades").count() == 60

    bad = raw(spark).withColumn("price", F.lit(None).cast("double"))
    blocked = load(spark, bad, root, "c")
    assert not blocked["published"] and blocked["blocked_by"] == ["contract"]
    assert G.logged(spark, root, "ingest_cursors").count() == 2
    assert G.logged(spark, root, "quality_events").where(
        "run_id = 'c' AND status = 'fail'").count() == 1

    before = snapshots.read(spark, f"{root}/trades").count()
    refused = G.restore(spark, SOURCE, root, now=NOW)      # the blocked file is in the landing zone
    assert refused["blocked_by"] == ["contract"]
    assert snapshots.read(spark, f"{root}/trades").count() == before


def test_contract_change_waits_for_acceptance(spark, tmp_path):
    root = str(tmp_path)
    load(spark, raw(spark), root, "a")
    newer = G.Source("ticks", C.Contract(CONTRACT.dataset, "2.0", CONTRACT.grain,
                                         CONTRACT.event_time_column, CONTRACT.columns), "trades")
    held = G.run_source(spark, newer, raw(spark), root, now=NOW, run_id="b")
    assert held["blocked_by"] == ["schema_version"]
    taken = G.run_source(spark, newer, raw(spark), root, now=NOW, run_id="c",
                         accept_schema_change=True)
    assert taken["published"]


def day_rows(spark, rows):
    """(id, day of January, price, version) as rows of a table."""
    return spark.createDataFrame(rows, "k long, day_no int, price double, v int").selectExpr(
        "k", "price", "make_date(2026, 1, day_no) AS d",
        "timestamp_ntz'2026-01-01' + make_dt_interval(v) AS ingested_at")


def held(spark, path, version=None):
    return sorted((r["k"], r["d"].day, r["price"]) for r in snapshots.read(spark, path, version).collect())


def test_a_moved_row_stands_once_and_other_days_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.upsert(spark, path, day_rows(spark, [(i, 1 + i // 10, 1.0, 0) for i in range(50)]), ["k"], "d", "a")
    before = snapshots.manifest(spark, path)
    snapshots.upsert(spark, path, day_rows(spark, [(5, 3, 2.0, 1), (7, 1, 9.0, -1), (70, 9, 3.0, 1)]), ["k"], "d", "b")
    want = {i: (1 + i // 10, 1.0) for i in range(50)} | {5: (3, 2.0), 70: (9, 3.0)}
    assert held(spark, path) == sorted((k, *r) for k, r in want.items())
    after = snapshots.manifest(spark, path)
    same = [p for p in before["parts"] if before["parts"][p] == after["parts"][p]]
    assert same == ["2026-01-02", "2026-01-04", "2026-01-05"]
    snapshots.upsert(spark, path, day_rows(spark, [(70, 1, 4.0, 2)]), ["k"], "d", "c")
    assert "2026-01-09" not in snapshots.manifest(spark, path)["parts"]
    assert held(spark, path, 1) == sorted((i, 1 + i // 10, 1.0) for i in range(50))


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = day_rows(spark, [(1, 1, 1.0, 0), (None, 1, 2.0, 0)])
    assert snapshots.upsert(spark, path, rows, ["k"], "d", "a") == 1
    assert snapshots.upsert(spark, path, rows.withColumn("price", F.lit(7.0)), ["k"], "d", "a") is None
    assert snapshots.upsert(spark, path, rows.limit(0), ["k"], "d", "b") is None
    assert snapshots.versions(spark, path) == [1]
    root = str(tmp_path / "root")
    first = load(spark, raw(spark), root, "a")
    again = load(spark, raw(spark, 60), root, "a")
    assert first == again and snapshots.read(spark, f"{root}/trades").count() == 50
    assert G.logged(spark, root, "quality_events").groupBy("check_name").count().where("count > 1").isEmpty()
    assert spark.read.parquet(f"{root}/raw/ticks").count() == 50


def test_a_broken_write_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.upsert(spark, path, day_rows(spark, [(1, 1, 1.0, 0), (2, 2, 1.0, 0)]), ["k"], "d", "a")
    bad = day_rows(spark, [(1, 1, 5.0, 1), (2, 2, 5.0, 1)])
    fails = bad.withColumn("price", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("price")))
    with pytest.raises(Exception, match="lost"):
        snapshots.replace(spark, path, fails, ["k"], "d", "b")

    def dies(*_):
        raise OSError("no manifest")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "publish", dies)
        with pytest.raises(OSError):
            snapshots.upsert(spark, path, bad, ["k"], "d", "b")
    assert held(spark, path) == [(1, 1, 1.0), (2, 2, 1.0)]
    snapshots.upsert(spark, path, bad, ["k"], "d", "b")
    assert held(spark, path) == [(1, 1, 5.0), (2, 2, 5.0)]
    assert snapshots.vacuum(spark, path, keep=1) >= 2 and held(spark, path) == [(1, 1, 5.0), (2, 2, 5.0)]


def test_the_second_of_two_writers_is_told(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.upsert(spark, path, day_rows(spark, [(1, 1, 1.0, 0)]), ["k"], "d", "a")
    state = snapshots.manifest(spark, path)
    snapshots.publish(spark, path, {**state, "runs": ["a", "x"]}, 2)
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark, path, {**state, "runs": ["a", "y"]}, 2)
    assert snapshots.manifest(spark, path)["runs"] == ["a", "x"]


def test_columns_may_be_added_or_left_out(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = day_rows(spark, [(1, 1, 1.0, 0), (2, 2, 2.0, 0)])
    snapshots.upsert(spark, path, rows, ["k"], "d", "a")
    more = day_rows(spark, [(1, 1, 1.0, 1)]).drop("price").withColumn("note", F.lit("n")).withColumn(
        "k", F.col("k").cast("int"))
    snapshots.upsert(spark, path, more, ["k"], "d", "b")
    got = {r["k"]: (r["price"], r["note"]) for r in snapshots.read(spark, path).collect()}
    assert got == {1: (None, "n"), 2: (2.0, None)}
    with pytest.raises(ValueError):
        snapshots.upsert(spark, str(tmp_path / "u"), rows, ["k"], "price")


def test_a_run_that_broke_off_can_be_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    def dies(*_, **__):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(G.Q, "vendor_scores", dies)
        with pytest.raises(OSError):
            load(spark, raw(spark), root, "a")
    assert G.summary_of(spark, root, "a") is None
    done = load(spark, raw(spark), root, "a")
    assert done["rows_loaded"] == 50 and snapshots.versions(spark, f"{root}/trades") == [1]
    assert snapshots.read(spark, f"{root}/trades").count() == 50


def test_the_source_is_read_twice_per_load(spark, tmp_path):
    gated = C.gate(raw(spark), CONTRACT, now=NOW)
    lazy, stored = gated.verdict().first().asDict(), gated.staged()
    assert stored.verdict().first().asDict() == lazy
    plan = stored.verdict()._jdf.queryExecution().toString()
    assert "FileScan" not in plan and stored.clean.count() == lazy["clean"]
    assert stored.rule_counts().collect() == gated.rule_counts().collect()


POLICY = N.Policy("research", {
    "ticks": {"licence": "open", "allow": ["research"]},
    "eod": {"licence": "internal", "allow": ["research"]},
    "platform_metadata": {"licence": "internal", "allow": ["platform"]}},
    {"external": {"allow_nothing": True}})


def test_serving_surface_and_audit(spark):
    log = []
    data = {"trades": trades(spark, [(i, 100 + i) for i in range(120)]), "eod_bars": eod(spark, dark()),
            "quality_events": spark.createDataFrame([(1,)], "event_at int")}
    md = MarketData(spark, data, POLICY, now=NOW, audit=lambda rows: log.extend(rows.collect()))
    times = asks(spark, [30.5, 90.5]).select("query_ts")
    assert [r["price"] for r in md.as_of("S", times, venue="v").orderBy("query_ts").collect()] == [
        130.0, 190.0]
    assert md.get_bars("S", freq="1m", venue="v").count() == 2
    assert md.get_trades("S", venue="v", limit=5).count() == 5
    assert md.research_frame("S", times, venue="v").count() == 2
    assert md.get_continuous("S", exchange="X").count() == 20
    assert {r["dataset"] for r in md.catalog().collect()} == {"trades", "eod_bars"}
    with pytest.raises(N.NotEntitled):
        md.quality()
    assert [r["allowed"] for r in log][-1] is False and log[0]["allowed"] is True
    with pytest.raises(N.NotEntitled):
        MarketData(spark, data, POLICY, now=NOW, consumer="external").get_trades("S", venue="v")

    def broken(_):
        raise OSError("disk full")

    with pytest.warns(UserWarning):
        MarketData(spark, data, POLICY, now=NOW, audit=broken).get_trades("S", venue="v")
