"""Bars, trade scans and duplicate resolution."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.plans.registry import query
from tidemark.sources import samples as S

BAR_COLUMNS = ["venue", "symbol", "bucket", "open", "high", "low", "close", "volume", "trades",
               "notional"]


def bar_sql(view: str, seconds: int, name: str = "b", where: str = "") -> str:
    return f"""{name} AS (
  SELECT venue, symbol, time_bucket(INTERVAL {seconds} SECOND, ts) AS bucket,
         first(price ORDER BY ts, trade_id) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY ts, trade_id) AS close, sum(qty) AS volume,
         count(*) AS trades, sum(price * qty) AS notional
  FROM {view} {where} GROUP BY ALL)"""


def rounded(bars):
    return bars.withColumn("volume", F.round("volume", 4)).withColumn(
        "notional", F.round("notional", 6))


ROUNDED = """SELECT venue, symbol, bucket, open, high, low, close, round(volume, 4) AS volume,
       trades, round(notional, 6) AS notional FROM """


@query("a1_ohlcv_bars", f"WITH {S.V_REPLAY}, {bar_sql('v_latest', 900)} {ROUNDED} b")
def a1(spark, sf):
    return rounded(B.ohlcv(S.replay(spark, sf), "15m"))


@query("a1_ohlcv_bars_range", f"""WITH {S.V_REPLAY}, {bar_sql('v_latest', 3600)} {ROUNDED} b
  WHERE bucket >= TIMESTAMP '2024-01-05 00:30:00' AND bucket < TIMESTAMP '2024-01-20 10:30:00'""")
def a1_range(spark, sf):
    return rounded(B.ohlcv(S.replay(spark, sf), "1h", "2024-01-05 00:30:00",
                           "2024-01-20 10:30:00"))


def _all_freq_sql() -> str:
    parts = [bar_sql("v_latest", s, f"b{s}") for s in (60, 300, 900, 3600, 86400)]
    union = " UNION ALL ".join(
        f"SELECT '{f}' AS freq, * FROM b{s}"
        for f, s in (("1m", 60), ("5m", 300), ("15m", 900), ("1h", 3600), ("1d", 86400)))
    return (f"WITH {S.V_REPLAY}, {', '.join(parts)} SELECT freq, symbol, count(*) AS bars, "
            f"sum(trades)::BIGINT AS trades, round(sum(volume), 4) AS volume, "
            f"round(sum(open + close), 3) AS open_close FROM ({union}) GROUP BY ALL")


@query("a2_bar_frequencies", _all_freq_sql())
def a2(spark, sf):
    """Every frequency, coarser ones rolled up from the minute bars."""
    minute = B.ohlcv(S.replay(spark, sf), "1m")
    out = None
    for freq in ("1m", "5m", "15m", "1h", "1d"):
        bars = minute if freq == "1m" else B.rollup(minute, freq)
        part = bars.groupBy(F.lit(freq).alias("freq"), "symbol").agg(
            F.count(F.lit(1)).alias("bars"), F.sum("trades").alias("trades"),
            F.round(F.sum("volume"), 4).alias("volume"),
            F.round(F.sum(F.col("open") + F.col("close")), 3).alias("open_close"))
        out = part if out is None else out.unionByName(part)
    return out


@query("a3_bar_rollup", f"WITH {S.V_REPLAY}, {bar_sql('v_latest', 3600)} {ROUNDED} b")
def a3(spark, sf):
    return rounded(B.rollup(B.ohlcv(S.replay(spark, sf), "1m"), "1h"))


@query("g1_distinct_on_grain", f"""WITH {S.V_REPLAY}
  SELECT venue, symbol, trade_id, ts, price, qty, is_buyer_maker, ingested_at FROM v_latest""")
def g1(spark, sf):
    return B.dedup_trades(S.replay(spark, sf))


@query("w4_latest_per_grain", f"""WITH {S.V_EOD_CORRECTED}
  SELECT exchange, symbol, expiry, trade_date, close, volume, ingested_at
  FROM v_eod_latest""")
def w4(spark, sf):
    latest = B.latest_per_grain(S.eod_corrected(spark, sf),
                                ["exchange", "symbol", "expiry", "trade_date"])
    return latest.select("exchange", "symbol", "expiry", "trade_date",
                         "close", "volume", "ingested_at")


@query("s7_time_range_scan", f"""WITH {S.V_TRADES}
  SELECT * FROM v_trades WHERE symbol = 'click' AND venue = 'sim'
    AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20'""")
def s7(spark, sf):
    from tidemark.plans.serve import select_trades
    return select_trades(S.trades(spark, sf), "click", "2024-01-03", "2024-01-20", venue="sim")


@query("h1_order_limit", f"""WITH {S.V_TRADES}
  SELECT * FROM v_trades WHERE symbol = 'view' AND venue = 'sim' ORDER BY ts LIMIT 50""")
def h1(spark, sf):
    from tidemark.plans.serve import select_trades
    return select_trades(S.trades(spark, sf), "view", venue="sim", limit=50)


@query("s8_eod_range_scan", f"""WITH {S.V_EOD_CORRECTED}
  SELECT exchange, symbol, expiry, trade_date, close, volume
  FROM v_eod_latest WHERE symbol = 'A' AND exchange = 'SIM'
    AND trade_date BETWEEN DATE '1997-02-03' AND DATE '1999-05-10'""")
def s8(spark, sf):
    from tidemark.plans.serve import select_eod
    return select_eod(S.eod_corrected(spark, sf), "A", "1997-02-03", "1999-05-10",
                      exchange="SIM").select(
        "exchange", "symbol", "expiry", "trade_date", "close",
        "volume")


@query("s10_adhoc_sql", """SELECT event_type, user_id % 10 AS cohort, count(*) AS n,
  round(sum(value), 2) AS total FROM events WHERE value > 5 GROUP BY event_type, user_id % 10""")
def s10(spark, sf):
    from tidemark.plans.serve import adhoc
    return adhoc(spark, {"events": S.table(spark, sf, "events")}, """
        SELECT event_type, user_id % 10 AS cohort, count(*) AS n, round(sum(value), 2) AS total
        FROM {events} WHERE value > 5 GROUP BY event_type, user_id % 10""")
