"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` choose the data and the cores. Each
query runs once to warm up and once for the clock. ``asof_2m_*``
repeats the events in time to reach two million trades.
"""
from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, functions as F

from tidemark import build_session
from tidemark.operators import asof as A
from tidemark.plans.catalogue import QUERIES
from tidemark.sources import samples as S

HEADLINE = [
    "a14_asof_benchmark", "j1_asof_backward", "j2_asof_many_keys", "j4_asof_staleness",
    "a1_ohlcv_bars", "a3_bar_rollup", "j7_trailing_window", "g1_distinct_on_grain",
    "v15_failure_rollup", "g6_ratio_adjusted", "m9_make_features", "m12_predictions",
]
TARGET_TRADES = 2_000_000


def many_trades(spark, sf_dir: str) -> DataFrame:
    """The events shifted in time often enough to give two million trades."""
    base = S.trades(spark, sf_dir)
    copies = max(1, round(TARGET_TRADES / max(base.count(), 1)))
    shift = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    out = base.withColumn("k", shift)
    moved = F.unix_micros(F.col("ts").cast("timestamp")) + F.col("k").cast("bigint") * 7_000_003
    return out.withColumn("ts", F.timestamp_micros(moved).cast("timestamp_ntz")).withColumn(
        "trade_id", F.col("trade_id") * copies + F.col("k")).drop("k")


def asof_2m(decisions: int):
    """Matched count and mean price of ``decisions`` per-minute decisions over 2 M trades."""
    def run(spark, sf_dir: str) -> DataFrame:
        trades = spark.read.parquet(spark.conf.get("bench.trades"))
        asked = spark.read.parquet(f"{spark.conf.get('bench.trades')}-asked-{decisions}")
        m = A.asof_join(asked, trades)
        return m.agg(F.count("price").alias("matched"), F.round(F.avg("price"), 4).alias("mean"))
    return run


def timed(fn, spark, sf_dir: str, runs: int = 1) -> float:
    best = float("inf")
    for i in range(runs + 1):
        start = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        if i:
            best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g", "spark.sql.files.maxPartitionBytes": "16m"})
    spark.sparkContext.setLogLevel("ERROR")
    from tidemark.session import scratch_dir

    path = scratch_dir(spark, "bench-trades")
    many_trades(spark, sf_dir).repartition(int(cpus)).write.parquet(path)
    spark.conf.set("bench.trades", path)
    minutes = spark.read.parquet(path).select("venue", "symbol", F.timestamp_micros(
        F.expr("unix_micros(cast(ts AS timestamp)) div 60000000 * 60000000 + 17500000"))
        .cast("timestamp_ntz").alias("query_ts")).distinct()
    for n in (5_000, 50_000):
        minutes.orderBy(F.xxhash64("symbol", "query_ts")).limit(n).write.parquet(
            f"{path}-asked-{n}")
    jobs = {name: QUERIES[name] for name in HEADLINE}
    jobs |= {"asof_2m_trades_5k": asof_2m(5_000), "asof_2m_trades_50k": asof_2m(50_000)}
    seconds = {name: timed(fn, spark, sf_dir) for name, fn in jobs.items()}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").split("sf")[-1],
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
