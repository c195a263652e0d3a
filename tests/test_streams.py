"""Tables as the state of streams: replays, late and moved rows, batches that broke off."""
import pytest
from pyspark.sql import functions as F

from tests.test_jobs import day_rows, held
from tidemark.operators.bars import ohlcv
from tidemark.sources import snapshots
from tidemark.streaming import intake as I


def test_only_new_keys_are_added(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "FOLDERS", 3)
    path, want = str(tmp_path / "t"), {}
    for n in range(6):
        batch = [(k, 1 + k % 2, float(n), n) for k in range(n, n + 4)] + [(n, 1 + n % 2, float(n), n)]
        want |= {k: (d, p) for k, d, p, _ in reversed(batch) if k not in want}
        snapshots.add_new(spark, path, day_rows(spark, batch), ["k"], "d", f"r{n}")
        assert snapshots.add_new(spark, path, day_rows(spark, batch), ["k"], "d", f"r{n}") is None
        assert held(spark, path) == sorted((k, *r) for k, r in want.items())
    assert all(len(p["folders"]) <= 3 for p in snapshots.manifest(spark, path)["parts"].values())
    moved = day_rows(spark, [(0, 9, 5.0, 9), (50, 9, 5.0, 9), (50, 9, 4.0, 9)])
    snapshots.add_new(spark, path, moved, ["k"], "d", "moved")
    assert held(spark, path) == sorted([(k, *r) for k, r in want.items()] + [(50, 9, 4.0)])
    assert snapshots.add_new(spark, path, moved, ["k"], "d", "again") is None


def prints(spark, rows):
    return spark.createDataFrame(rows, "trade_id long, minute int, price double, v int").selectExpr(
        "'v' AS venue", "'S' AS symbol", "trade_id",
        "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, minute) AS ts", "price", "1.0D AS qty",
        "timestamp_ntz'2026-02-01' + make_dt_interval(v) AS ingested_at")


def test_bars_of_a_batch_that_broke_off(spark, tmp_path, monkeypatch):
    drop, trades, bars, check = (str(tmp_path / n) for n in ("drop", "trades", "bars", "check"))
    every = [prints(spark, [(i, 7 * i, 100.0 + i, 0) for i in range(40)]),
             prints(spark, [(3, 21, 103.0, 0), (5, 1500, 9.0, 1), (99, 2, 50.0, 0)]),
             prints(spark, [(5, 3000, 8.0, 2), (0, 0, 100.0, 0)])]

    def one_pass():
        I.keep_bars(I.file_stream(spark, drop, every[0].schema), trades, bars, check)

    def dies(*_, **__):
        raise OSError("gone")

    for k, rows in enumerate(every):
        rows.coalesce(1).write.mode("append").parquet(drop)
        if k == 1:
            with monkeypatch.context() as m:
                m.setattr(snapshots, "replace", dies)
                with pytest.raises(Exception, match="gone"):
                    one_pass()
            assert len(snapshots.versions(spark, trades)) == 2 and len(snapshots.versions(spark, bars)) == 1
        one_pass()
    got = snapshots.read(spark, bars).drop("trade_day")
    want = ohlcv(every[0].unionByName(every[1]).unionByName(every[2]), "15m")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.where("open = 9").isEmpty() and snapshots.read(spark, trades).count() == 41
    one_pass()
    assert snapshots.versions(spark, bars) == [1, 2, 3]


def test_replays_over_passes(spark, tmp_path):
    drop, out, check = (str(tmp_path / n) for n in ("drop", "out", "check"))
    for k in range(3):
        prints(spark, [(i, i, float(k), 0) for i in range(5 * k, 5 * k + 10)]).coalesce(1).write.mode(
            "append").parquet(drop)
        stream = I.file_stream(spark, drop, prints(spark, []).schema).withColumn("day", F.to_date("ts"))
        I.keep_new(stream, out, check, partition="day")
    got = {r["trade_id"]: r["price"] for r in snapshots.read(spark, out).collect()}
    assert got == {i: float(max(0, (i - 5) // 5)) for i in range(20)}
