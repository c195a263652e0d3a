"""Adapters from the driver's tables to the shapes the engine works on.

Each view exists twice: as a DataFrame here and as a common table expression for
the DuckDB check, so both sides start from the same rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import pin_utc

NOW = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    name = F.col("event_type") if symbol == "event_type" else F.concat(
        F.lit("U"), F.col("user_id").cast("string"))
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.lit("sim").alias("venue"), name.alias("symbol"), F.col("event_id").alias("trade_id"),
        "ts", F.col("value").alias("price"), (1 + k / F.lit(100.0)).alias("qty"),
        (F.col("event_id") % 2 == 0).alias("is_buyer_maker"),
        (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("ingested_at"))


V_TRADES = """v_trades AS (
  SELECT 'sim' AS venue, event_type AS symbol, event_id AS trade_id, ts, value AS price,
         1 + CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) / CAST(100 AS DOUBLE) AS qty,
         event_id % 2 = 0 AS is_buyer_maker, ts + INTERVAL 1 SECOND AS ingested_at
  FROM events)"""

V_TRADES_USER = V_TRADES.replace("v_trades", "v_trades_user").replace(
    "event_type AS symbol", "'U' || CAST(user_id AS VARCHAR) AS symbol")


def replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades with every 50th delivered twice and every 70th corrected later."""
    base = trades(spark, sf_dir)
    again = base.where(F.col("trade_id") % 50 == 0).withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 60 SECONDS"))
    fixed = (
        base.where(F.col("trade_id") % 70 == 0)
        .withColumn("price", F.col("price") * 2)
        .withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 120 SECONDS")))
    return base.unionByName(again).unionByName(fixed)


V_REPLAY = V_TRADES + """, v_replay AS (
  SELECT * FROM v_trades
  UNION ALL BY NAME
  SELECT * REPLACE (ingested_at + INTERVAL 60 SECOND AS ingested_at)
  FROM v_trades WHERE trade_id % 50 = 0
  UNION ALL BY NAME
  SELECT * REPLACE (ingested_at + INTERVAL 120 SECOND AS ingested_at, price * 2 AS price)
  FROM v_trades WHERE trade_id % 70 = 0),
 v_latest AS (
  SELECT * FROM v_replay
  QUALIFY row_number() OVER (PARTITION BY venue, symbol, trade_id ORDER BY ingested_at DESC) = 1)"""


def decisions(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    """A grid off the minute edge, every trade's own time, and a key nobody traded."""
    base = trades(spark, sf_dir, symbol)
    minute = F.timestamp_micros(
        F.unix_micros(F.col("ts").cast("timestamp"))
        - F.pmod(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(60_000_000))
    ).cast("timestamp_ntz")
    grid = base.select("venue", "symbol",
                       (minute + F.expr("INTERVAL '17.5' SECOND")).alias("query_ts"))
    exact = base.select("venue", "symbol", F.col("ts").alias("query_ts"))
    unknown = grid.withColumn("symbol", F.lit("NOSUCH"))
    return grid.unionByName(exact).unionByName(unknown).dropDuplicates()


def v_decisions(trades_view: str = "v_trades", name: str = "v_decisions") -> str:
    return f"""{name} AS (
  SELECT DISTINCT venue, symbol,
         date_trunc('minute', ts) + INTERVAL 17500 MILLISECOND AS query_ts FROM {trades_view}
  UNION SELECT venue, symbol, ts FROM {trades_view}
  UNION SELECT venue, 'NOSUCH', date_trunc('minute', ts) + INTERVAL 17500 MILLISECOND
    FROM {trades_view})"""


V_DECISIONS = v_decisions()


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as text with planted defects, one undeclared column, replays included."""
    t = replay(spark, sf_dir)
    i = F.col("trade_id")
    far = "2031-01-01 00:00:00"
    return t.select(
        F.when(i % 107 == 0, "other").otherwise(F.col("venue")).alias("venue"),
        "symbol", i.cast("string").alias("trade_id"),
        F.when(i % 103 == 0, "not a time").when(i % 109 == 0, far)
        .otherwise(F.col("ts").cast("string")).alias("ts"),
        F.when(i % 97 == 0, "0").when(i % 89 == 0, "n/a")
        .otherwise(F.col("price").cast("string")).alias("price"),
        F.when(i % 101 == 0, F.lit(None)).otherwise(F.col("qty").cast("string")).alias("qty"),
        F.col("is_buyer_maker").cast("string").alias("is_buyer_maker"),
        F.lit("x").alias("vendor_note"),
        F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("arrived"))


V_RAW = V_REPLAY + """, v_raw AS (
  SELECT CASE WHEN trade_id % 107 = 0 THEN 'other' ELSE venue END AS venue, symbol,
         CAST(trade_id AS VARCHAR) AS trade_id,
         CASE WHEN trade_id % 103 = 0 THEN 'not a time'
              WHEN trade_id % 109 = 0 THEN '2031-01-01 00:00:00'
              ELSE CAST(ts AS VARCHAR) END AS ts,
         CASE WHEN trade_id % 97 = 0 THEN '0' WHEN trade_id % 89 = 0 THEN 'n/a'
              ELSE CAST(price AS VARCHAR) END AS price,
         CASE WHEN trade_id % 101 = 0 THEN NULL ELSE CAST(qty AS VARCHAR) END AS qty,
         CAST(is_buyer_maker AS VARCHAR) AS is_buyer_maker, 'x' AS vendor_note,
         strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%f') AS arrived
  FROM v_replay),
 v_typed AS (
  SELECT *, TRY_CAST(trade_id AS BIGINT) AS id_v, TRY_CAST(ts AS TIMESTAMP) AS ts_v,
         TRY_CAST(price AS DOUBLE) AS price_v, TRY_CAST(qty AS DOUBLE) AS qty_v,
         TRY_CAST(is_buyer_maker AS BOOLEAN) AS maker_v
  FROM v_raw),
 v_gated AS (
  SELECT *, CASE
      WHEN ts IS NOT NULL AND ts_v IS NULL THEN 'ts not coercible to timestamp_ms'
      WHEN price IS NOT NULL AND price_v IS NULL THEN 'price not coercible to float'
      WHEN qty IS NULL THEN 'qty is required but null'
      WHEN venue <> 'sim' THEN 'venue outside allowed values'
      WHEN id_v < 1 THEN 'trade_id below minimum'
      WHEN price_v <= 0 THEN 'price below minimum'
      WHEN qty_v <= 0 THEN 'qty below minimum'
      WHEN NOT coalesce(price_v * qty_v < 100000, false)
        THEN 'cross-field rule failed: notional_is_sane'
      WHEN ts_v > TIMESTAMP '2024-01-31 00:01:00' THEN 'event time in the future'
    END AS reason
  FROM v_typed),
 v_clean AS (
  SELECT venue, symbol, id_v AS trade_id, ts_v AS ts, price_v AS price, qty_v AS qty,
         maker_v AS is_buyer_maker, arrived
  FROM v_gated WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY venue, symbol, id_v ORDER BY arrived) = 1)"""


def eod(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contract and day, two expiries trading side by side."""
    day = F.to_date("l_shipdate")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    p = F.col("l_extendedprice") / F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select(
        F.lit("SIM").alias("exchange"), F.col("l_returnflag").alias("symbol"),
        F.last_day(F.add_months(day, (F.col("l_suppkey") % 2).cast("int"))).alias("expiry"),
        day.alias("trade_date"), p.alias("_p"), order.alias("_o"), "l_quantity")
    return rows.groupBy("exchange", "symbol", "expiry", "trade_date").agg(
        F.min_by("_p", "_o").alias("open"), F.max("_p").alias("high"),
        F.min("_p").alias("low"), F.max_by("_p", "_o").alias("close"),
        F.max_by("_p", "_o").alias("settle"), F.sum("l_quantity").alias("volume"),
        F.count(F.lit(1)).cast("double").alias("open_interest"),
    ).withColumn("ingested_at", F.date_add("trade_date", 1).cast("timestamp_ntz"))


V_EOD = """v_eod AS (
  SELECT 'SIM' AS exchange, l_returnflag AS symbol,
         CAST(last_day(CAST(l_shipdate AS DATE) + to_months(CAST(l_suppkey % 2 AS INTEGER))) AS DATE)
           AS expiry,
         CAST(l_shipdate AS DATE) AS trade_date,
         first(l_extendedprice / l_quantity
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS open,
         max(l_extendedprice / l_quantity) AS high,
         min(l_extendedprice / l_quantity) AS low,
         last(l_extendedprice / l_quantity
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS close,
         last(l_extendedprice / l_quantity
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS settle,
         sum(l_quantity) AS volume, CAST(count(*) AS DOUBLE) AS open_interest,
         CAST(CAST(l_shipdate AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS ingested_at
  FROM lineitem GROUP BY ALL)"""


def eod_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End-of-day rows plus a later restatement of the first days of each month.

    The far contract turns out to have traded far less, so some rolls move.
    """
    base = eod(spark, sf_dir)
    far = F.col("expiry") > F.last_day("trade_date")
    fixed = (
        base.where(F.dayofmonth("trade_date") <= 3)
        .withColumn("close", F.col("close") * 2)
        .withColumn("volume", F.when(far, F.col("volume") / 128).otherwise(F.col("volume") * 4))
        .withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 7 DAYS")))
    return base.unionByName(fixed)


V_EOD_CORRECTED = V_EOD + """, v_eod_corrected AS (
  SELECT * FROM v_eod UNION ALL BY NAME
  SELECT * REPLACE (close * 2 AS close, ingested_at + INTERVAL 7 DAY AS ingested_at,
    CASE WHEN expiry > last_day(trade_date) THEN volume / 128 ELSE volume * 4 END AS volume)
  FROM v_eod WHERE dayofmonth(trade_date) <= 3),
 v_eod_latest AS (
  SELECT * FROM v_eod_corrected
  QUALIFY row_number() OVER (PARTITION BY exchange, symbol, expiry, trade_date
                             ORDER BY ingested_at DESC) = 1)"""
