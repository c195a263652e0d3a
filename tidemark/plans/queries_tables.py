"""Landing, keyed writes, restores, run records and the streaming twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import contract as C
from tidemark.operators import deliveries as D
from tidemark.plans import delivery as L
from tidemark.plans import ingest as G
from tidemark.plans import queries_model as QM
from tidemark.plans import queries_roll as QR
from tidemark.plans import recipes as P
from tidemark.plans import runs
from tidemark.plans.queries_gate import RAW, TRADES
from tidemark.plans.registry import query
from tidemark.session import scratch_dir
from tidemark.sources import landing, snapshots, tables
from tidemark.sources import samples as S
from tidemark.streaming import intake as I

# ---- landing -----------------------------------------------------------------------


@query("w1_landing_write", f"""WITH {S.V_TRADES} SELECT symbol, DATE '2024-01-31' AS ingest_date,
  count(*) AS rows, round(sum(price), 4) AS total FROM v_trades GROUP BY symbol""")
def w1(spark, sf):
    root = scratch_dir(spark, "landing")
    path = landing.write_raw(S.trades(spark, sf), root, "ticks", when=S.NOW)
    return spark.read.parquet(path).groupBy("symbol", "ingest_date").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("price"), 4).alias("total"))


@query("w2_quarantine_write", f"""{RAW} SELECT reason, count(*) AS rows FROM v_gated
  WHERE reason IS NOT NULL GROUP BY reason""")
def w2(spark, sf):
    root = scratch_dir(spark, "quarantine")
    gated = C.gate(S.raw_trades(spark, sf), TRADES, now=S.NOW, arrival=["arrived"])
    path = landing.write_quarantine(gated.rejected, root, "ticks", when=S.NOW)
    return spark.read.parquet(path).groupBy(F.col(C.REASON).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"))


@query("s6_landing_replay", f"""WITH {S.V_REPLAY} SELECT symbol, count(*) AS rows,
  count(DISTINCT trade_id) AS trades FROM v_replay GROUP BY symbol""")
def s6(spark, sf):
    """Two deliveries, the second without one column, read back as one history."""
    root = scratch_dir(spark, "replay")
    rows = S.replay(spark, sf)
    first = S.trades(spark, sf)
    landing.write_raw(first, root, "ticks", when="2024-01-30")
    again = rows.where("trade_id % 50 = 0 OR trade_id % 70 = 0").join(
        first.select("trade_id", "ingested_at"), ["trade_id", "ingested_at"], "left_anti")
    landing.write_raw(again.drop("is_buyer_maker"), root, "ticks", when="2024-01-31")
    return landing.replay(spark, root, "ticks").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("trade_id").alias("trades"))


@query("w3_keyed_insert", f"""WITH {S.V_REPLAY}, moved AS (SELECT * REPLACE (
    CASE WHEN trade_id % 70 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts) FROM v_latest)
  SELECT venue, symbol, trade_id, ts, price, qty, is_buyer_maker, ingested_at,
    CAST(ts AS DATE) AS trade_day FROM moved""")
def w3(spark, sf):
    """Insert the first prints, then merge replays and corrections; these move a trade to the next day."""
    path = scratch_dir(spark, "trades")
    key = ["venue", "symbol", "trade_id"]
    snapshots.upsert(spark, path, S.trades(spark, sf).withColumn("trade_day", F.to_date("ts")), key,
                     "trade_day", "first")
    moved = F.when(F.col("trade_id") % 70 == 0, F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts"))
    later = S.replay(spark, sf).where("trade_id % 50 = 0 OR trade_id % 70 = 0").withColumn(
        "ts", moved).withColumn("trade_day", F.to_date("ts"))
    for _ in range(2):
        snapshots.upsert(spark, path, later, key, "trade_day", "later")
    return snapshots.read(spark, path)


SOURCE = G.Source("sim", TRADES, "trades", checks=("contract", "uniqueness", "monotonic_trade_id",
                                                   "gap_scan"), min_rows=1, incremental=True)
RELAXED = C.Contract(TRADES.dataset, TRADES.schema_version, TRADES.grain,
                     TRADES.event_time_column, TRADES.columns,
                     {**TRADES.rules, "max_null_fraction": 0.5})
LOOSE = G.Source("sim", RELAXED, "trades", checks=SOURCE.checks, min_rows=1, incremental=True)


@query("r4_run_source", f"""{RAW} SELECT 'sim' AS source, count(*) AS rows_acquired,
  (SELECT count(*) FROM v_clean) AS rows_clean, count(reason) AS rows_quarantined,
  (SELECT count(*) FROM v_clean) AS rows_loaded, true AS published FROM v_gated""")
def r4(spark, sf):
    root = scratch_dir(spark, "load")
    raw = S.raw_trades(spark, sf).drop("arrived")
    out = G.run_source(spark, LOOSE, raw, root, now=S.NOW, run_id="load-1")
    loaded = snapshots.read(spark, f"{root}/trades")
    return loaded.agg(
        F.lit(out["source"]).alias("source"), F.lit(out["rows_acquired"]).cast("bigint").alias("rows_acquired"),
        F.lit(out["rows_clean"]).cast("bigint").alias("rows_clean"),
        F.lit(out["rows_quarantined"]).cast("bigint").alias("rows_quarantined"),
        F.count(F.lit(1)).alias("rows_loaded"), F.lit(out["published"]).alias("published"))


@query("r4_blocked_load", f"""{RAW} SELECT count(*) AS rows_acquired, 0::BIGINT AS rows_loaded,
  'contract' AS blocked_by FROM v_gated""")
def r4b(spark, sf):
    """The same rows against the tight budget: nothing is published, everything is recorded."""
    root = scratch_dir(spark, "blocked")
    raw = S.raw_trades(spark, sf).drop("arrived")
    out = G.run_source(spark, SOURCE, raw, root, now=S.NOW, run_id="load-1")
    return G.logged(spark, root, "quality_events").where("status = 'fail'").agg(
        F.lit(out["rows_acquired"]).cast("bigint").alias("rows_acquired"),
        F.lit(out["rows_loaded"]).cast("bigint").alias("rows_loaded"),
        F.array_join(F.sort_array(F.collect_set("check_name")), ",").alias("blocked_by"))


@query("w5_restore_from_landing", f"""{RAW} SELECT count(*) AS rows_restored, 0::BIGINT AS only_left,
  0::BIGINT AS only_right FROM v_clean""")
def w5(spark, sf):
    """Load, rebuild from the landing zone, compare the two tables."""
    root = scratch_dir(spark, "restore")
    raw = S.raw_trades(spark, sf).drop("arrived")
    G.run_source(spark, LOOSE, raw, root, now=S.NOW, run_id="load-1")
    keep = snapshots.read(spark, f"{root}/trades").drop("ingested_at")
    before = scratch_dir(spark, "before")
    keep.write.parquet(before)
    out = G.restore(spark, LOOSE, root, now=S.NOW)
    after = snapshots.read(spark, f"{root}/trades").drop("ingested_at")
    return tables.difference(spark.read.parquet(before), after).withColumn(
        "rows_restored", F.lit(out["rows_restored"]).cast("bigint"))


PINNED = P.Recipe("five_days", "1", {"target.horizon_days": 5},
                  {"baseline": {}, "stronger_penalty": {"estimator.alpha": 25.0}})
RUNS = f"""{QM.ASSIGNED}, runs AS (SELECT 'five_days.1.' || exchange || '.' || symbol || '.' || s.scenario AS run_id, *
  FROM tests, (VALUES ('baseline'), ('stronger_penalty')) s(scenario))"""


def pinned_runs(spark, sf):
    root = scratch_dir(spark, "runs")
    for _ in range(2):
        registry = runs.run_pinned(QM.series(spark, sf), PINNED, root, started=S.NOW, finished=S.NOW, pinned="close")
    return root, registry


@query("w6_run_artifacts", f"""{RUNS} SELECT run_id, count(*) AS rows, count(DISTINCT fold) AS folds,
  round(sum(target), 6) AS actual FROM runs GROUP BY run_id""")
def w6(spark, sf):
    """Runs of two scenarios, made twice, read back by their ids."""
    root, registry = pinned_runs(spark, sf)
    return runs.load_artifact(spark, root, "predictions").join(registry.select("run_id"), "run_id").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("fold").alias("folds"),
        F.round(F.sum("actual"), 6).alias("actual"))


@query("w7_run_registry", f"""{RUNS}{QR.DIGEST[QR.DIGEST.index(", mo AS"):]},
  d AS (SELECT DISTINCT run_id, exchange, symbol, scenario FROM runs)
  SELECT run_id, 'five_days:' || scenario AS model, last_date AS data_through, series_sha AS fingerprint,
    rows AS input_rows, CASE scenario WHEN 'baseline' THEN '1.0' ELSE '25.0' END AS alpha,
    (SELECT count(DISTINCT fold) FROM runs r WHERE r.run_id = d.run_id) AS folds
  FROM d JOIN pin USING (exchange, symbol)""")
def w7(spark, sf):
    field = lambda c, path: F.get_json_object(c, path)
    return pinned_runs(spark, sf)[1].select(
        "run_id", "model", "data_through", field("params", "$.fingerprint").alias("fingerprint"),
        field("params", "$.input_rows").cast("bigint").alias("input_rows"),
        field(field("params", "$.settings"), "$['estimator.alpha']").alias("alpha"),
        field("metrics", "$.folds").cast("bigint").alias("folds"))


@query("w8_retention_report", """SELECT 'symbol=' || event_type AS folder, 1::BIGINT AS files,
  CASE WHEN event_type < 'p' THEN 1 ELSE 0 END::BIGINT AS expired_files FROM events GROUP BY event_type""")
def w8(spark, sf):
    """One file a symbol; those up to a letter are dated back past the limit."""
    root = scratch_dir(spark, "kept")
    landing.write_raw(S.trades(spark, sf).coalesce(1), root, "ticks", when=S.NOW)
    for path in (r["path"] for r in D.file_listing(spark, root, "*.parquet").select("path").collect()):
        target, fs = snapshots.file_system(spark, path)
        fs.setTimes(target, 1_700_000_000_000 if path.split("symbol=")[1] < "p" else 4_102_444_800_000, -1)
    return landing.retention_report(spark, root, now="2100-01-02", days=90).select(
        "folder", "files", "expired_files")


# ---- streams -----------------------------------------------------------------------
def landed(spark, sf, rows, label):
    """Rows written as files, to be read back as a stream."""
    path = scratch_dir(spark, label)
    rows.write.parquet(path)
    return path


@query("k4_incremental_poll", "SELECT event_type, count(*) AS rows FROM events GROUP BY event_type")
def k4(spark, sf):
    """Two passes over a growing folder; the second reads only what is new."""
    events = S.table(spark, sf, "events")
    drop = landed(spark, sf, events.where("event_id % 3 = 0"), "poll")
    out, checkpoint = I.workspace(spark, "poll-out")
    I.to_table(I.file_stream(spark, drop, events.schema), out, checkpoint)
    events.where("event_id % 3 <> 0").write.mode("append").parquet(drop)
    I.to_table(I.file_stream(spark, drop, events.schema), out, checkpoint)
    return spark.read.parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


@query("k5_stream_replay_dedup", f"""WITH {S.V_TRADES} SELECT venue, symbol, trade_id, ts, price
  FROM v_trades""")
def k5(spark, sf):
    """Three passes over files in mixed order of time, with replays in later files."""
    rows = S.trades(spark, sf).select("venue", "symbol", "trade_id", "ts", "price")
    out, checkpoint = I.workspace(spark, "dedup")
    drop = scratch_dir(spark, "replays")
    for k in range(3):
        rows.where(f"trade_id % 3 = {2 - k} OR trade_id % 4 = {k}").write.mode("append").parquet(drop)
        stream = I.file_stream(spark, drop, rows.schema).withColumn("trade_day", F.to_date("ts"))
        I.keep_new(stream, out, checkpoint, partition="trade_day")
    return snapshots.read(spark, out).drop("trade_day")


@query("k6_stream_bars", f"""WITH {S.V_REPLAY}, moved AS (SELECT * REPLACE (
    CASE WHEN trade_id % 70 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts) FROM v_latest)
  SELECT venue, symbol, time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, first(price ORDER BY ts, trade_id) AS open,
    max(price) AS high, min(price) AS low, last(price ORDER BY ts, trade_id) AS close,
    round(sum(qty), 4) AS volume, count(*) AS trades, round(sum(price * qty), 4) AS notional
  FROM moved GROUP BY ALL""")
def k6(spark, sf):
    """Three passes in mixed order of time: late trades, replays, and corrections that move to the next day."""
    later = F.col("ingested_at") > F.col("ts") + F.expr("INTERVAL 90 SECONDS")
    rows = S.replay(spark, sf).withColumn(
        "ts", F.when(later, F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts")))
    out, checkpoint = I.workspace(spark, "bars")
    drop = scratch_dir(spark, "ticks")
    for k in range(3):
        rows.where(f"trade_id % 3 = {2 - k}").write.mode("append").parquet(drop)
        if k:
            rows.where(f"trade_id % 3 = {3 - k} AND trade_id % 4 = 0").write.mode("append").parquet(drop)
        I.keep_bars(I.file_stream(spark, drop, rows.schema), f"{out}/trades", f"{out}/bars", checkpoint)
    return snapshots.read(spark, f"{out}/bars").select(
        "venue", "symbol", "bucket", "open", "high", "low", "close", F.round("volume", 4).alias("volume"),
        "trades", F.round("notional", 4).alias("notional"))


@query("k7_late_and_future_rows", """SELECT CASE WHEN ts > TIMESTAMP '2024-01-20 00:01:00' THEN 'future'
  WHEN event_id % 5 = 0 AND ts < (SELECT max(ts) FROM events WHERE event_id % 5 <> 0
       AND ts <= TIMESTAMP '2024-01-20 00:01:00') - INTERVAL 10 MINUTE THEN 'late'
  ELSE 'accepted' END AS route, count(*) AS rows FROM events GROUP BY 1""")
def k7(spark, sf):
    """A second delivery brings rows from before the mark the first one set."""
    events = S.table(spark, sf, "events").select("event_id", "ts")
    drop = landed(spark, sf, events.where("event_id % 5 <> 0"), "first")
    out, checkpoint = I.workspace(spark, "routes")

    def one_pass():
        I.route_stream(I.file_stream(spark, drop, events.schema), out, checkpoint,
                       now="2024-01-20 00:00:00")

    one_pass()
    events.where("event_id % 5 = 0").write.mode("append").parquet(drop)
    one_pass()
    return I.batches(spark, f"{out}/rows").groupBy("route").agg(F.count(F.lit(1)).alias("rows"))


#: Rows of one file that a query drops; a larger table comes in more files.
FILE_ROWS = 1_000_000


def drop_files(spark, rows, folder, name, *by, files=None, fmt="parquet"):
    """Rows as files of names of our own, as a vendor would drop them; no task sees more than one of them.

    Rows equal in ``by`` share a file. Gives back the paths.
    """
    files = files or max(1, -(-rows.count() // FILE_ROWS))
    part = scratch_dir(spark, "part")
    rows.repartition(files, *by).write.format(fmt).save(part)
    source, fs = snapshots.file_system(spark, part)
    ending = ".txt" if fmt == "text" else f".{fmt}"
    made = sorted((s.getPath() for s in fs.listStatus(source) if s.getPath().getName().endswith(ending)),
                  key=lambda p: p.getName())
    fs.mkdirs(snapshots.file_system(spark, folder)[0])
    paths = [f"{folder}/{name}{k or ''}.parquet" for k in range(len(made))]
    for old, new in zip(made, paths):
        fs.rename(old, snapshots.file_system(spark, new)[0])
    return paths


def copy_file(spark, path, to):
    source, fs = snapshots.file_system(spark, path)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        fs, source, fs, snapshots.file_system(spark, to)[0], False, spark._jsc.hadoopConfiguration())


@query("k8_drop_scan", """SELECT l_returnflag AS symbol, count(*) AS rows FROM lineitem
  WHERE l_returnflag <> 'A' GROUP BY 1""")
def k8(spark, sf):
    """Files of one symbol each: those of A are still being written, those of R were loaded before and came again."""
    drop = scratch_dir(spark, "drop")
    lines = S.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("symbol"), F.col("l_orderkey").cast("string").alias("id"))
    # The line's order decides its file, so no two files of a symbol are equal.
    sent = {symbol: drop_files(spark, lines.where(F.col("symbol") == symbol), drop, symbol, "id") for symbol in "ANR"}
    for path in sent["R"]:
        copy_file(spark, path, path[:-len(".parquet")] + "-again.parquet")
    for path in sent["N"]:
        copy_file(spark, path, path.replace(f"{drop}/", f"{drop}/."))
    for path in sent["A"]:
        growing, fs = snapshots.file_system(spark, path)
        fs.setTimes(growing, 7_258_118_400_000, -1)
    files = D.fingerprints(D.settled_files(spark, drop, "*.parquet", now="2190-01-01", settle_seconds=60))
    waiting = D.waiting(files, spark.createDataFrame([], "fingerprint string, ok boolean"))
    return spark.read.schema(lines.schema).parquet(*(r["path"] for r in waiting.collect())).groupBy(
        "symbol").agg(F.count(F.lit(1)).alias("rows"))


@query("k9_delivery_identity", """SELECT event_type AS symbol, count(*) AS rows,
  sha256(string_agg(CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || chr(10), ''
    ORDER BY event_id)) AS fingerprint FROM events GROUP BY event_type""")
def k9(spark, sf):
    """One text file a symbol; its identity is the digest of its bytes."""
    events = S.table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("symbol"),
        F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string")).alias("line"))
    path = scratch_dir(spark, "identity")
    events.repartition("symbol").sortWithinPartitions("symbol", "event_id").select("symbol", "line").write.partitionBy(
        "symbol").text(path)
    named = F.regexp_extract("path", "symbol=([^/]*)/", 1).alias("symbol")
    prints = D.fingerprints(D.settled_files(spark, path, "*.txt", now="2190-01-01")).select(named, "fingerprint")
    return prints.join(events.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")), "symbol")


@query("k11_delivery_gate", f"""{RAW}, f(file, attempts, ok, blocked_by, rows_loaded) AS (VALUES
    ('blocked', 2, false, 'contract', 0), ('broken', 2, false, 'acquisition_error', 0),
    ('good', 1, true, NULL, -1))
  SELECT file, CAST(attempts AS BIGINT) AS attempts, ok, blocked_by, (SELECT count(*) FROM v_clean) AS rows_in_table,
    CASE WHEN rows_loaded < 0 THEN (SELECT count(*) FROM v_clean) ELSE 0 END AS rows_loaded FROM f""")
def k11(spark, sf):
    """A good file and its copy, one that the gate blocks, one that cannot be read; three passes, two attempts."""
    root = scratch_dir(spark, "deliveries")
    drop, raw = f"{root}/drop", S.raw_trades(spark, sf).drop("arrived")
    sound = "qty IS NOT NULL AND ts <> 'not a time' AND price <> 'n/a'"
    # All versions of one trade come in one file, so what a load keeps does not depend on the number of files.
    good = drop_files(spark, raw.where(sound), drop, "good", "symbol", "trade_id")
    blocked = drop_files(spark, raw, drop, "blocked", "symbol", "trade_id")
    drop_files(spark, raw.select("symbol", "trade_id").select(F.concat_ws(",", "symbol", "trade_id").alias("value")),
               drop, "broken", "value", files=len(blocked), fmt="text")
    for _ in range(3):
        L.handle_drop(spark, SOURCE, drop, root, now=S.NOW, pattern="*.parquet", max_attempts=2,
                      settle_seconds=-10**10)
        for path in good:
            copy_file(spark, path, path.replace(f"{drop}/good", f"{drop}/good-resent"))
    name = F.regexp_extract("path", r"([a-z]+)[^/]*$", 1).alias("file")
    loaded = snapshots.read(spark, f"{root}/trades").agg(F.count(F.lit(1))).scalar()
    attempts = L.ledger(spark, root).groupBy("path").agg(
        F.count(F.lit(1)).alias("attempts"), F.bool_or("ok").alias("ok"),
        F.max("blocked_by").alias("blocked_by"), F.sum("rows_loaded").alias("rows_loaded"))
    return attempts.groupBy(name).agg(
        F.max("attempts").alias("attempts"), F.bool_and("ok").alias("ok"),
        F.max("blocked_by").alias("blocked_by"), F.sum("rows_loaded").alias("rows_loaded"),
        loaded.alias("rows_in_table"))
