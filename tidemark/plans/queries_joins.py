"""As-of joins, trailing windows and the look-ahead audit."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import asof as A
from tidemark.operators import bars as B
from tidemark.operators import trailing as T
from tidemark.plans.queries_bars import bar_sql
from tidemark.plans.registry import query
from tidemark.sources import samples as S


def asof_sql(decisions: str, trades: str, op: str = ">=", name: str = "m") -> str:
    return f"""{name} AS (
  SELECT q.venue, q.symbol, q.query_ts, t.ts AS trade_ts, t.trade_id, t.price
  FROM {decisions} q ASOF LEFT JOIN {trades} t
    ON q.venue = t.venue AND q.symbol = t.symbol AND q.query_ts {op} t.ts)"""


BASE = f"WITH {S.V_REPLAY}, {S.V_DECISIONS}"

#: Of trades of one instant the highest id is matched; an ASOF join alone takes any of them.
SETTLED = """v_settled AS (
  SELECT * FROM v_latest
  QUALIFY row_number() OVER (PARTITION BY venue, symbol, ts ORDER BY trade_id DESC) = 1)"""


@query("j1_asof_backward", f"{BASE}, {SETTLED}, {asof_sql('v_decisions', 'v_settled')} SELECT * FROM m")
def j1(spark, sf):
    return A.asof_join(S.decisions(spark, sf), S.replay(spark, sf), version="ingested_at")


@query("j2_asof_many_keys", f"""WITH {S.V_TRADES_USER}, {S.v_decisions('v_trades_user', 'v_d')},
  {asof_sql('v_d', 'v_trades_user')} SELECT * FROM m""")
def j2(spark, sf):
    return A.asof_join(S.decisions(spark, sf, "user"), S.trades(spark, sf, "user"),
                       few_decisions=False)


@query("j2_asof_broadcast", f"""WITH {S.V_TRADES_USER}, {S.v_decisions('v_trades_user', 'v_d')},
  {asof_sql('v_d', 'v_trades_user')} SELECT * FROM m""")
def j2b(spark, sf):
    return A.asof_join(S.decisions(spark, sf, "user"), S.trades(spark, sf, "user"))


@query("j3_asof_strict_many",
       f"{BASE}, {SETTLED}, {asof_sql('v_decisions', 'v_settled', '>')} SELECT * FROM m")
def j3b(spark, sf):
    return A.asof_join(S.decisions(spark, sf), S.replay(spark, sf), version="ingested_at", strict=True,
                       few_decisions=False)


@query("j3_asof_strict", f"{BASE}, {asof_sql('v_decisions', 'v_latest', '>')} SELECT * FROM m")
def j3(spark, sf):
    return A.asof_join(S.decisions(spark, sf), S.replay(spark, sf), version="ingested_at", strict=True)


STALE = """SELECT venue, symbol, query_ts, trade_ts, trade_id,
  CASE WHEN age <= 60 THEN price END AS price, age AS staleness_seconds,
  coalesce(age > 60, true) AS stale
  FROM (SELECT *, date_diff('microsecond', trade_ts, query_ts) / CAST(1000000 AS DOUBLE) AS age
        FROM m)"""


@query("j4_asof_staleness", f"{BASE}, {SETTLED}, {asof_sql('v_decisions', 'v_settled')} {STALE}")
def j4(spark, sf):
    matched = A.asof_join(S.decisions(spark, sf), S.replay(spark, sf), version="ingested_at")
    return A.with_staleness(matched, 60.0)


@query("j5_asof_unknown_key", f"""{BASE}, {asof_sql('v_decisions', 'v_latest')}
  SELECT symbol, count(*) AS decisions, count(trade_ts) AS matched,
         count(*) FILTER (trade_ts IS NULL) AS unmatched FROM m GROUP BY symbol""")
def j5(spark, sf):
    m = A.asof_join(S.decisions(spark, sf), S.replay(spark, sf), version="ingested_at", prune_keys=True)
    return m.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("decisions"), F.count("trade_ts").alias("matched"),
        F.count_if(F.col("trade_ts").isNull()).alias("unmatched"))


@query("j6_decision_normalise", """SELECT DISTINCT event_type AS symbol,
  date_trunc('hour', ts) AS query_ts FROM events WHERE event_id % 11 <> 0""")
def j6(spark, sf):
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss")
    raw = S.table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"),
        F.when(F.col("event_id") % 11 != 0, hour)
        .when(F.col("event_id") % 2 == 0, "never").alias("query_ts"))
    return A.normalise_decisions(raw, ["symbol"])


@query("j6b_decision_grid", f"""WITH {S.V_REPLAY}, {bar_sql('v_latest', 900)}
  SELECT venue, symbol, bucket + INTERVAL 17500 MILLISECOND AS query_ts FROM b
  QUALIFY row_number() OVER (PARTITION BY venue, symbol ORDER BY bucket DESC) <= 200""")
def j6b(spark, sf):
    return A.decision_grid(B.ohlcv(S.replay(spark, sf), "15m"), newest=200)


#: A bar after a close of zero has no return.
RETURNS = """r AS (
  SELECT *, close / nullif(lag(close) OVER (PARTITION BY venue, symbol ORDER BY bucket), 0) - 1 AS ret
  FROM b)"""


def half_up(value: str, digits: int) -> str:
    """Half up on the decimal digits of a double, as Spark rounds; DuckDB's own multiplies the double first."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def trailing_sql(window: int, name: str, upper: str) -> str:
    return f"""{name} AS (
  SELECT q.venue, q.symbol, q.query_ts, stddev_samp(r.ret) AS vol, count(r.bucket) AS n
  FROM v_decisions q LEFT JOIN r ON q.venue = r.venue AND q.symbol = r.symbol
    AND r.bucket >= q.query_ts - INTERVAL {window} MINUTE AND {upper}
  GROUP BY ALL)"""


ENDED = "r.bucket + INTERVAL 1 MINUTE <= q.query_ts"
STARTED = "r.bucket < q.query_ts"


@query("j7_trailing_window", f"""{BASE}, {bar_sql('v_latest', 60)}, {RETURNS},
  {trailing_sql(120, 'w', ENDED)}
  SELECT venue, symbol, query_ts, {half_up('vol', 8)} AS realised_vol, n AS bars_in_window FROM w""")
def j7(spark, sf):
    returns = T.bar_returns(B.ohlcv(S.replay(spark, sf), "1m"))
    out = T.attach_trailing(S.decisions(spark, sf), returns, window_minutes=120)
    return out.withColumn("realised_vol", F.round("realised_vol", 8))


@query("j8_lookahead_audit", f"""{BASE}, {bar_sql('v_latest', 60)}, {RETURNS},
  {trailing_sql(240, 'w1', ENDED)}, {trailing_sql(240, 'w2', STARTED)}
  SELECT symbol, count(*) AS decisions, {half_up('quantile_cont(ratio, 0.5)', 6)} AS median_ratio,
         {half_up('max(ratio)', 6)} AS worst_ratio,
         {half_up('avg(CAST(ratio > 1.05 AS DOUBLE))', 6)} AS share_over
  FROM (SELECT w1.symbol, w2.vol / nullif(w1.vol, 0) AS ratio
        FROM w1 JOIN w2 USING (venue, symbol, query_ts)
        WHERE w1.vol IS NOT NULL AND w2.vol IS NOT NULL)
  GROUP BY symbol""")
def j8(spark, sf):
    returns = T.bar_returns(B.ohlcv(S.replay(spark, sf), "1m"))
    out = T.audit_summary(T.lookahead_audit(S.decisions(spark, sf), returns, window_minutes=240))
    return out.select("symbol", "decisions", *[
        F.round(c, 6).alias(c) for c in ("median_ratio", "worst_ratio", "share_over")])


@query("g16_bar_returns", f"""WITH {S.V_REPLAY}, {bar_sql('v_latest', 60)}, {RETURNS}
  SELECT venue, symbol, bucket, close, {half_up('ret', 8)} AS ret FROM r""")
def g16(spark, sf):
    out = T.bar_returns(B.ohlcv(S.replay(spark, sf), "1m"))
    return out.select("venue", "symbol", "bucket", "close", F.round("ret", 8).alias("ret"))


@query("a14_asof_benchmark", f"""WITH {S.V_TRADES}, {S.V_DECISIONS},
  {asof_sql('v_decisions', 'v_trades')}
  SELECT count(price) AS matched, round(avg(price), 4) AS avg_price FROM m""")
def a14(spark, sf):
    m = A.asof_join(S.decisions(spark, sf), S.trades(spark, sf))
    return m.agg(F.count("price").alias("matched"), F.round(F.avg("price"), 4).alias("avg_price"))


@query("a16_staleness_summary", f"""{BASE}, {asof_sql('v_decisions', 'v_latest')}
  SELECT symbol, round(quantile_cont(age, 0.5), 6) AS median_age, max(age) AS worst_age
  FROM (SELECT symbol, date_diff('microsecond', trade_ts, query_ts) / CAST(1000000 AS DOUBLE) AS age
        FROM m) WHERE age IS NOT NULL GROUP BY symbol""")
def a16(spark, sf):
    m = A.with_staleness(A.asof_join(S.decisions(spark, sf), S.replay(spark, sf), version="ingested_at"))
    return A.staleness_summary(m).withColumn("median_age", F.round("median_age", 6))


@query("n1_research_frame", f"""{BASE}, {SETTLED}, {asof_sql('v_decisions', 'v_settled')},
  {bar_sql('v_latest', 60)}, {RETURNS}, {trailing_sql(60, 'w', ENDED)},
  s AS ({STALE})
  SELECT s.*, {half_up('w.vol', 8)} AS realised_vol, w.n AS bars_in_window
  FROM s JOIN w USING (venue, symbol, query_ts)""")
def n1(spark, sf):
    from tidemark.plans.serve import research_frame
    out = research_frame(S.decisions(spark, sf), S.replay(spark, sf), window_minutes=60)
    return out.withColumn("realised_vol", F.round("realised_vol", 8))
