"""Scans, the contract gate and its report."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import contract as C
from tidemark.plans.registry import query
from tidemark.sources import drops
from tidemark.sources import samples as S

TRADES = C.Contract.from_dict({
    "dataset": "sim_trades", "schema_version": "1.0",
    "grain": ["venue", "symbol", "trade_id"], "event_time_column": "ts",
    "columns": [
        {"name": "venue", "type": "string", "required": True, "allowed": ["sim"]},
        {"name": "symbol", "type": "string", "required": True},
        {"name": "trade_id", "type": "int", "required": True, "min": 1},
        {"name": "ts", "type": "timestamp_ms", "required": True},
        {"name": "price", "type": "float", "required": True, "min": 0, "exclusive_min": True},
        {"name": "qty", "type": "float", "required": True, "min": 0, "exclusive_min": True},
        {"name": "is_buyer_maker", "type": "bool", "required": True},
    ],
    "rules": {"unique_on": ["venue", "symbol", "trade_id"], "reject_future_events_seconds": 60,
              "max_null_fraction": 0.02, "max_reject_fraction": 0.5,
              "cross_field": [{"name": "notional_is_sane",
                               "expr": "price * qty < 100000"}]},
})


def gated(spark, sf, contract=TRADES):
    return C.gate(S.raw_trades(spark, sf), contract, now=S.NOW, arrival=["arrived"])


@query("s1_file_drop_scan", """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate
  FROM lineitem""")
def s1(spark, sf):
    df = drops.read_drop(spark, f"{sf}/lineitem.parquet")
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query("s2_column_map", """SELECT o_orderkey AS order_id, o_totalprice AS price, 'SIM' AS exchange,
  o_orderstatus FROM orders""")
def s2(spark, sf):
    df = drops.map_columns(
        S.table(spark, sf, "orders"),
        {"o_orderkey": "order_id", "o_totalprice": "price", "NotThere": "volume"},
        {"exchange": "SIM"})
    return df.select("order_id", "price", "exchange", "o_orderstatus")


@query("s3_header_alias", """SELECT o_orderkey AS symbol, o_orderdate AS trade_date,
  o_totalprice AS close FROM orders""")
def s3(spark, sf):
    raw = S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias(" Symbol "), F.col("o_orderdate").alias("Trade Date"),
        F.col("o_totalprice").alias("CLOSE PRICE"), F.col("o_orderstatus").alias("spare"))
    return drops.pick_aliases(raw, {
        "symbol": ["instrument", "symbol"], "trade_date": ["date", "trade_date"],
        "close": ["close", "close_price"], "settle": ["settle", "settlement"]})


@query("s4_symbol_allow_list", """SELECT event_id, event_type, ts FROM events
  WHERE event_type IN ('click', 'purchase')""")
def s4(spark, sf):
    return drops.allow_symbols(S.table(spark, sf, "events"), ["click", "purchase"],
                               "event_type").select("event_id", "event_type", "ts")


@query("s5_day_slice", """SELECT event_id, ts FROM events
  WHERE CAST(ts AS DATE) = DATE '2024-01-17'""")
def s5(spark, sf):
    return drops.day_slice(S.table(spark, sf, "events"), "ts", "2024-01-17").select(
        "event_id", "ts")


RAW = f"WITH {S.V_RAW}"


@query("v3_declared_projection", f"""{RAW} SELECT venue, symbol, id_v AS trade_id, price_v AS price
  FROM v_gated""")
def v3(spark, sf):
    return gated(spark, sf).rows.select("venue", "symbol", "trade_id", "price")


@query("v4_typed_coercion", f"""{RAW} SELECT symbol, id_v AS trade_id, ts_v AS ts, price_v AS price,
  qty_v AS qty, maker_v AS is_buyer_maker FROM v_gated""")
def v4(spark, sf):
    return gated(spark, sf).rows.select(
        "symbol", "trade_id", "ts", "price", "qty", "is_buyer_maker")


RULES_SQL = """SELECT rule, count(*) AS rows FROM (
  SELECT 'ts not coercible to timestamp_ms' AS rule FROM v_gated WHERE ts IS NOT NULL AND ts_v IS NULL
  UNION ALL SELECT 'price not coercible to float' FROM v_gated
    WHERE price IS NOT NULL AND price_v IS NULL
  UNION ALL SELECT 'qty is required but null' FROM v_gated WHERE qty IS NULL
  UNION ALL SELECT 'venue outside allowed values' FROM v_gated WHERE venue <> 'sim'
  UNION ALL SELECT 'trade_id below minimum' FROM v_gated WHERE id_v < 1
  UNION ALL SELECT 'price below minimum' FROM v_gated WHERE price_v <= 0
  UNION ALL SELECT 'qty below minimum' FROM v_gated WHERE qty_v <= 0
  UNION ALL SELECT 'cross-field rule failed: notional_is_sane' FROM v_gated
    WHERE NOT coalesce(price_v * qty_v < 100000, false)
  UNION ALL SELECT 'event time in the future' FROM v_gated
    WHERE ts_v > TIMESTAMP '2024-01-31 00:01:00') GROUP BY rule"""


def _one_rule(name: str, text: str):
    @query(name, f"{RAW}, f AS ({RULES_SQL}) SELECT * FROM f WHERE rule LIKE '{text}'")
    def run(spark, sf):
        return gated(spark, sf).rule_counts().select("rule", "rows").where(
            F.col("rule").like(text))
    return run


v5 = _one_rule("v5_required_null", "%required but null")
v6 = _one_rule("v6_allowed_values", "%outside allowed values")
v7 = _one_rule("v7_minimum", "%below minimum")
v9 = _one_rule("v9_cross_field_rule", "cross-field%")
v10 = _one_rule("v10_future_event", "%future")


@query("v8_maximum", """SELECT l_orderkey, l_linenumber, 'l_discount above maximum' AS reason
  FROM lineitem WHERE l_discount > 0.08""")
def v8(spark, sf):
    contract = C.Contract.from_dict({
        "dataset": "lines", "grain": ["l_orderkey", "l_linenumber"],
        "event_time_column": "l_shipdate",
        "columns": [{"name": "l_orderkey", "type": "int", "required": True},
                    {"name": "l_linenumber", "type": "int", "required": True},
                    {"name": "l_discount", "type": "float", "max": 0.08}]})
    rows = C.gate(S.table(spark, sf, "lineitem"), contract, now=S.NOW).rejected
    return rows.select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"),
                       F.col(C.REASON).alias("reason"))


@query("v11_first_reason", f"""{RAW} SELECT symbol, id_v AS trade_id, reason, arrived FROM v_gated
  WHERE reason IS NOT NULL""")
def v11(spark, sf):
    g = gated(spark, sf)
    return g.rows.where(F.col(C.REASON).isNotNull()).select(
        "symbol", "trade_id", F.col(C.REASON).alias("reason"), "arrived")


@query("v11_rule_counts", f"{RAW} {RULES_SQL}")
def v11b(spark, sf):
    return gated(spark, sf).rule_counts().select("rule", "rows")


@query("v12_dedup_first_arrival", f"""{RAW}
  SELECT venue, symbol, trade_id, ts, price, qty, is_buyer_maker FROM v_clean""")
def v12(spark, sf):
    return gated(spark, sf).clean


TOTALS = """t AS (
  SELECT count(*) AS rows, count(reason) AS rejected,
         count(*) FILTER (reason LIKE '%coercible%' OR reason LIKE '%null') AS null_rejected,
         (SELECT count(*) FROM v_clean) AS clean FROM v_gated)"""


@query("v13_null_fraction", f"""{RAW}, {TOTALS}
  SELECT null_rejected, round(null_rejected / rows, 8) AS null_fraction,
         null_rejected / rows > 0.02 AS breached FROM t""")
def v13(spark, sf):
    return gated(spark, sf).verdict().select(
        "null_rejected", F.round("null_fraction", 8).alias("null_fraction"),
        F.col("max_null_fraction_breached").alias("breached"))


@query("v14_reject_fraction", f"""{RAW}, {TOTALS}
  SELECT rejected, round(rejected / rows, 8) AS reject_fraction,
         rejected / rows > 0.5 AS breached FROM t""")
def v14(spark, sf):
    return gated(spark, sf).verdict().select(
        "rejected", F.round("reject_fraction", 8).alias("reject_fraction"),
        F.col("max_reject_fraction_breached").alias("breached"))


@query("v15_failure_rollup", f"""{RAW}, {TOTALS}
  SELECT rows, rejected, clean, rows - rejected - clean AS duplicates, clean + rejected AS rows_in,
         null_rejected / rows > 0.02 OR rejected / rows > 0.5 AS blocking FROM t""")
def v15(spark, sf):
    return gated(spark, sf).verdict().select(
        "rows", "rejected", "clean", "duplicates", "rows_in", "blocking")


@query("v1_missing_column", """SELECT 'missing_column' AS kind, count(*) AS rejected FROM events""")
def v1(spark, sf):
    g = C.gate(S.table(spark, sf, "events"), TRADES, now=S.NOW)
    return g.rows.where(F.col(C.REASON).isNotNull()).agg(
        F.lit(g.notes[0]["kind"]).alias("kind"), F.count(F.lit(1)).alias("rejected"))


@query("v2_empty_input", f"""{RAW} SELECT count(*) AS rows, count(*) = 0 AS blocking FROM v_raw
  WHERE CAST(trade_id AS BIGINT) < -1""")
def v2(spark, sf):
    empty = S.raw_trades(spark, sf).where("CAST(trade_id AS BIGINT) < -1")
    return C.gate(empty, TRADES, now=S.NOW, arrival=["arrived"]).verdict().select(
        "rows", "blocking")


@query("i1_union_by_name", f"""{RAW} SELECT symbol, count(*) AS rows, count(reason) AS rejected
  FROM v_gated GROUP BY symbol""")
def i1(spark, sf):
    g = gated(spark, sf)
    both = C.union_frames([g.accepted.drop(C.REASON), g.rejected])
    return both.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"),
                                      F.count(C.REASON).alias("rejected"))
