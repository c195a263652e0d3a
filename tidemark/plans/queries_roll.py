"""Front month, continuous series, versioned reference data."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.operators import roll as R
from tidemark.operators import versions as V
from tidemark.plans import reference as ref
from tidemark.plans.registry import query
from tidemark.session import scratch_dir
from tidemark.plans.serve import EOD_GRAIN
from tidemark.sources import samples as S

W = "PARTITION BY exchange, symbol ORDER BY trade_date"


def front_sql(eod: str = "v_eod", method: str = "volume", name: str = "front") -> str:
    if method == "nearest":
        return f"""{name} AS (SELECT exchange, symbol, trade_date, min(expiry) AS expiry FROM {eod}
  WHERE expiry >= trade_date + INTERVAL 3 DAY GROUP BY ALL)"""
    return f"""{name} AS (SELECT exchange, symbol, trade_date, expiry FROM {eod}
  WHERE expiry >= trade_date QUALIFY row_number() OVER (PARTITION BY exchange, symbol, trade_date
    ORDER BY volume DESC NULLS LAST, expiry) = 1)"""


def mono_sql(front: str = "front", name: str = "mono") -> str:
    return f"""{name} AS (SELECT exchange, symbol, trade_date,
  max(expiry) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS expiry FROM {front})"""


def series_sql(eod: str = "v_eod", mono: str = "mono") -> str:
    return f"""series AS (SELECT m.exchange, m.symbol, m.trade_date, m.expiry, e.close, e.volume,
  e.open_interest FROM {mono} m JOIN {eod} e USING (exchange, symbol, trade_date, expiry)
  WHERE e.close IS NOT NULL),
 flagged AS (SELECT *, lag(expiry) OVER ({W}) AS prev_expiry,
  coalesce(expiry <> lag(expiry) OVER ({W}), false) AS is_roll FROM series),
 pairs AS (SELECT r.exchange, r.symbol, r.expiry, r.prev_expiry, r.trade_date,
   arg_max(o.close, o.trade_date) AS old_price, arg_max(n.close, n.trade_date) AS new_price,
   max(o.trade_date) AS splice_date
   FROM flagged r
   JOIN {eod} o ON o.exchange = r.exchange AND o.symbol = r.symbol AND o.expiry = r.prev_expiry
     AND o.trade_date <= r.trade_date AND o.close <> 0
   JOIN {eod} n ON n.exchange = r.exchange AND n.symbol = r.symbol AND n.expiry = r.expiry
     AND n.trade_date = o.trade_date AND n.close IS NOT NULL
   WHERE r.is_roll GROUP BY ALL),
 joined AS (SELECT f.*, p.old_price, p.new_price FROM flagged f
   LEFT JOIN pairs p USING (exchange, symbol, trade_date)),
 cont AS (SELECT *,
   close * coalesce(product(new_price / old_price) OVER later, 1) AS ratio_close,
   close + coalesce(sum(new_price - old_price) OVER later, 0) AS diff_close,
   CASE WHEN is_roll THEN old_price IS NOT NULL END AS roll_adjusted FROM joined
   WINDOW later AS ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""


BASE = f"WITH {S.V_EOD}, {front_sql()}, {mono_sql()}"
FULL = f"{BASE}, {series_sql()}"


@query("g2_front_by_volume", f"WITH {S.V_EOD}, {front_sql()} SELECT * FROM front")
def g2(spark, sf):
    return R.front_by_volume(S.eod(spark, sf))


@query("g3_front_by_expiry", f"WITH {S.V_EOD}, {front_sql(method='nearest')} SELECT * FROM front")
def g3(spark, sf):
    return R.front_by_expiry(S.eod(spark, sf), 3)


@query("g4_no_backward_roll", f"""{BASE} SELECT *, trade_date AS known_from, true AS is_front
  FROM mono""")
def g4(spark, sf):
    return R.front_month_map(S.eod(spark, sf))


@query("j9_roll_map_prices", f"""{FULL} SELECT exchange, symbol, trade_date, expiry, close, volume
  FROM series""")
def j9(spark, sf):
    eod = S.eod(spark, sf)
    return R.front_prices(eod, R.front_month_map(eod).select(
        "exchange", "symbol", "trade_date", "expiry")).select(
        "exchange", "symbol", "trade_date", "expiry", "close", "volume")


def flagged(spark, sf):
    eod = S.eod(spark, sf)
    return R.flag_rolls(R.front_prices(eod, R.front_month_map(eod)))


@query("g5_roll_flag", f"""{FULL} SELECT exchange, symbol, trade_date, expiry, prev_expiry, is_roll
  FROM flagged""")
def g5(spark, sf):
    return flagged(spark, sf).select(
        "exchange", "symbol", "trade_date", "expiry", "prev_expiry", "is_roll")


@query("j10_splice_pairs", f"""{FULL} SELECT exchange, symbol, expiry, prev_expiry,
  trade_date AS roll_date, old_price, new_price, splice_date FROM pairs""")
def j10(spark, sf):
    return R.splice_pairs(S.eod(spark, sf), flagged(spark, sf).where("is_roll"))


@query("g6_ratio_adjusted", f"""{FULL} SELECT exchange, symbol, trade_date, expiry, is_roll, close,
  round(ln(ratio_close), 6) AS log_adj_close, volume, open_interest FROM cont""")
def g6(spark, sf):
    out = R.continuous_series(S.eod(spark, sf), adjust="ratio")
    return out.select("exchange", "symbol", "trade_date", "expiry", "is_roll", "close",
                      F.round(F.ln("adj_close"), 6).alias("log_adj_close"), "volume",
                      "open_interest")


@query("g7_difference_adjusted", f"""{FULL} SELECT symbol, trade_date, expiry,
  round(diff_close, 5) AS adj_close FROM cont""")
def g7(spark, sf):
    return R.continuous_series(S.eod(spark, sf), adjust="difference").select(
        "symbol", "trade_date", "expiry", F.round("adj_close", 5).alias("adj_close"))


@query("g8_raw_splice", f"""{FULL} SELECT symbol, trade_date, expiry, is_roll,
  CAST(NULL AS BOOLEAN) AS roll_adjusted, close AS adj_close FROM cont""")
def g8(spark, sf):
    return R.continuous_series(S.eod(spark, sf), adjust="none").select(
        "symbol", "trade_date", "expiry", "is_roll", "roll_adjusted", "adj_close")


@query("g9_roll_adjusted_flag", f"""{FULL} SELECT symbol, trade_date, is_roll, roll_adjusted
  FROM cont""")
def g9(spark, sf):
    return R.continuous_series(S.eod(spark, sf)).select(
        "symbol", "trade_date", "is_roll", "roll_adjusted")


@query("g9_unadjustable_rolls", f"""WITH {S.V_EOD}, v_gap AS (SELECT * FROM v_eod WHERE
    NOT (expiry > last_day(trade_date) AND month(expiry) % 3 = 0)),
  {front_sql('v_gap')}, {mono_sql()}, {series_sql('v_gap')}
  SELECT symbol, trade_date, roll_adjusted, round(ln(ratio_close), 6) AS log_adj_close FROM cont
  WHERE is_roll""")
def g9b(spark, sf):
    """Every third contract never overlaps the one before it."""
    eod = S.eod(spark, sf).where(
        ~((F.col("expiry") > F.last_day("trade_date")) & (F.month("expiry") % 3 == 0)))
    return R.continuous_series(eod).where("is_roll").select(
        "symbol", "trade_date", "roll_adjusted",
        F.round(F.ln("adj_close"), 6).alias("log_adj_close"))


@query("g10_continuous_as_of", f"""WITH {S.V_EOD}, v_cut AS (SELECT * FROM v_eod
    WHERE trade_date <= DATE '1999-06-30'), {front_sql('v_cut', 'nearest')}, {mono_sql()},
  {series_sql('v_cut')} SELECT symbol, trade_date, expiry, is_roll,
  round(ln(ratio_close), 6) AS log_adj_close FROM cont""")
def g10(spark, sf):
    return R.continuous_series(S.eod(spark, sf), method="nearest", as_of="1999-06-30").select(
        "symbol", "trade_date", "expiry", "is_roll",
        F.round(F.ln("adj_close"), 6).alias("log_adj_close"))


@query("g17_worst_roll_jump", f"""{FULL}, jumps AS (SELECT exchange, symbol, trade_date, is_roll,
    close / lag(close) OVER ({W}) - 1 AS jump FROM cont)
  SELECT exchange, symbol, arg_max(trade_date, abs(jump)) AS trade_date,
         round(max(abs(jump)), 8) AS size, count(*) AS rolls
  FROM jumps WHERE is_roll AND jump IS NOT NULL GROUP BY ALL""")
def g17(spark, sf):
    return R.worst_jump(R.continuous_series(S.eod(spark, sf))).withColumn(
        "size", F.round("size", 8))


@query("h5_tail_days", f"""{FULL} SELECT symbol, trade_date, close FROM cont
  QUALIFY row_number() OVER (PARTITION BY exchange, symbol ORDER BY trade_date DESC) <= 120""")
def h5(spark, sf):
    return R.tail_days(R.continuous_series(S.eod(spark, sf)), 120).select(
        "symbol", "trade_date", "close")


RET = f"""ret AS (SELECT symbol, trade_date, is_roll, close / lag(close) OVER ({W}) - 1 AS raw_ret,
  ratio_close / lag(ratio_close) OVER ({W}) - 1 AS adj_ret FROM cont)"""


@query("j17_roll_artefact", f"""{FULL}, {RET} SELECT symbol, trade_date, is_roll,
  round(raw_ret, 7) AS raw_ret, round(adj_ret, 7) AS adj_ret FROM ret""")
def j17(spark, sf):
    out = R.returns_compared(R.continuous_series(S.eod(spark, sf)))
    return out.select("symbol", "trade_date", "is_roll", F.round("raw_ret", 7).alias("raw_ret"),
                      F.round("adj_ret", 7).alias("adj_ret"))


@query("o1_roll_chart", f"""{FULL}, {RET}, z AS (SELECT *, row_number() OVER (
    PARTITION BY symbol ORDER BY trade_date DESC) AS rn FROM ret)
  SELECT symbol, trade_date, is_roll, round(raw_ret - adj_ret, 7) AS artefact FROM z
  WHERE rn <= 250""")
def o1(spark, sf):
    out = R.tail_days(R.returns_compared(R.continuous_series(S.eod(spark, sf))), 250)
    return out.select("symbol", "trade_date", "is_roll", F.round("artefact", 7).alias("artefact"))


DIGEST = f"""{FULL}, mo AS (SELECT exchange, symbol, date_trunc('month', trade_date) AS month, count(*) AS n,
    min(trade_date) AS a, max(trade_date) AS b, sha256(string_agg(CAST(trade_date AS VARCHAR) || ':' ||
    CAST(CAST(round(close * 1000000) AS BIGINT) AS VARCHAR), chr(10) ORDER BY trade_date)) AS d FROM cont GROUP BY ALL),
 pin AS (SELECT exchange, symbol, sum(n)::BIGINT AS rows, min(a) AS first_date, max(b) AS last_date,
    sha256(string_agg(d, chr(10) ORDER BY month)) AS series_sha FROM mo GROUP BY exchange, symbol)"""


@query("a17_series_fingerprint", f"{DIGEST} SELECT * FROM pin")
def a17(spark, sf):
    return R.fingerprint(R.continuous_series(S.eod(spark, sf)), "close")


# ---- versioned map -----------------------------------------------------------------
TODAY = "2002-03-01"
KNOWN = "2002-01-10"


def restated(spark, sf):
    """The first map, the corrected rows and the map chosen from them."""
    first = V.first_map(R.front_month_map(S.eod(spark, sf)), today=KNOWN)
    latest = B.latest_per_grain(S.eod_corrected(spark, sf), EOD_GRAIN)
    return first, R.front_month_map(latest)


MAPS = f"""WITH {S.V_EOD_CORRECTED}, {front_sql()}, {mono_sql()},
  {front_sql('v_eod_latest', name='front2')}, {mono_sql('front2', 'mono2')},
  cmp AS (SELECT n.exchange, n.symbol, n.trade_date, n.expiry, o.expiry AS expiry_known,
    CASE WHEN o.expiry IS NULL THEN 'new' WHEN o.expiry <> n.expiry THEN 'changed'
         ELSE 'unchanged' END AS state
    FROM mono2 n LEFT JOIN mono o USING (exchange, symbol, trade_date)),
  mapped AS (
    SELECT o.exchange, o.symbol, o.trade_date, o.expiry, DATE '{KNOWN}' AS known_from,
      CASE WHEN c.state = 'changed' THEN DATE '{TODAY}' - INTERVAL 1 DAY ELSE DATE '2999-12-31' END
        ::DATE AS known_to FROM mono o LEFT JOIN cmp c USING (exchange, symbol, trade_date)
    UNION ALL SELECT exchange, symbol, trade_date, expiry, DATE '{TODAY}', DATE '2999-12-31'
      FROM cmp WHERE state <> 'unchanged')"""


@query("j13_map_compare", f"{MAPS} SELECT * FROM cmp")
def j13(spark, sf):
    first, chosen = restated(spark, sf)
    return V.compare_map(chosen, first)


@query("j14_superseded_rows", f"""{MAPS} SELECT exchange, symbol, trade_date, expiry_known AS expiry
  FROM cmp WHERE state = 'changed'""")
def j14(spark, sf):
    first, chosen = restated(spark, sf)
    return V.superseded(first, V.compare_map(chosen, first)).select(
        "exchange", "symbol", "trade_date", "expiry")


@query("r1_map_refresh", f"{MAPS} SELECT * FROM mapped")
def r1(spark, sf):
    """Three refreshes of the stored map, the last of them a repeated run; read back as one table."""
    root = scratch_dir(spark, "reference")
    latest = B.latest_per_grain(S.eod_corrected(spark, sf), EOD_GRAIN)
    for bars, today, run in ((S.eod(spark, sf), KNOWN, "a"), (latest, TODAY, "b"), (latest, TODAY, "b")):
        ref.refresh(spark, root, R.front_month_map(bars), today=today, run_id=run)
    return ref.stored_map(spark, root).select("exchange", "symbol", "trade_date", "expiry", "known_from", "known_to")


@query("r1_refresh_counts", f"""{MAPS} SELECT count(*) FILTER (state <> 'unchanged') AS opened,
  count(*) FILTER (state = 'changed') AS closed, count(*) FILTER (state = 'unchanged') AS unchanged
  FROM cmp""")
def r1b(spark, sf):
    first, chosen = restated(spark, sf)
    return V.refresh_counts(chosen, first)


@query("r3_map_as_of", f"""{MAPS} SELECT exchange, symbol, trade_date, expiry FROM mapped
  WHERE known_from <= DATE '2002-02-01' AND known_to >= DATE '2002-02-01'
  QUALIFY row_number() OVER (PARTITION BY exchange, symbol, trade_date
                             ORDER BY known_from DESC) = 1""")
def r3(spark, sf):
    first, chosen = restated(spark, sf)
    table = V.refresh_map(chosen, first, today=TODAY)
    return R.newest_belief(V.known_on(table.where("is_front"), "2002-02-01"))


@query("r3_series_from_stored_map", f"""{MAPS}, newest AS (SELECT exchange, symbol, trade_date,
    expiry FROM mapped QUALIFY row_number() OVER (PARTITION BY exchange, symbol, trade_date
    ORDER BY known_from DESC) = 1), {mono_sql('newest', 'mono3')},
  {series_sql('v_eod_latest', 'mono3')} SELECT symbol, trade_date, expiry, is_roll,
  round(ln(ratio_close), 6) AS log_adj_close FROM cont""")
def r3b(spark, sf):
    first, chosen = restated(spark, sf)
    table = V.refresh_map(chosen, first, today=TODAY)
    eod = B.latest_per_grain(S.eod_corrected(spark, sf), EOD_GRAIN)
    return R.continuous_series(eod, roll_map=table.where("is_front")).select(
        "symbol", "trade_date", "expiry", "is_roll",
        F.round(F.ln("adj_close"), 6).alias("log_adj_close"))


# ---- specifications ----------------------------------------------------------------
V_SPECS = """v_specs AS (
  SELECT 'SIM' AS exchange, l_returnflag AS symbol, 50::DOUBLE AS lot_size,
         DATE '1996-01-01' AS known_from, DATE '1997-12-31' AS known_to FROM lineitem GROUP BY 2
  UNION ALL SELECT 'SIM', l_returnflag, 100::DOUBLE, DATE '1998-01-01', DATE '2999-12-31'
    FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 2)"""


def specs(spark, sf):
    """Two versions per symbol; symbol R stops at the boundary."""
    symbols = S.table(spark, sf, "lineitem").select(
        F.lit("SIM").alias("exchange"), F.col("l_returnflag").alias("symbol")).distinct()
    versions = F.array(*[
        F.struct(F.lit(lot).alias("lot_size"), F.lit(a).cast("date").alias("known_from"),
                 F.lit(b).cast("date").alias("known_to"))
        for lot, a, b in ((50.0, "1996-01-01", "1997-12-31"), (100.0, "1998-01-01", V.OPEN_END))])
    return symbols.select("exchange", "symbol", F.explode(versions).alias("v")).select(
        "exchange", "symbol", "v.*").where("NOT (symbol = 'R' AND lot_size = 100)")


@query("r2_versioned_specs", f"WITH {V_SPECS} SELECT * FROM v_specs")
def r2(spark, sf):
    """Specifications as a configuration names them, loaded twice and read back."""
    root = scratch_dir(spark, "specs")
    raw: dict = {}
    for r in specs(spark, sf).collect():        # two versions for each of three symbols
        raw.setdefault(r["exchange"], {}).setdefault(r["symbol"], []).append(
            {"lot_size": r["lot_size"], "tick_size": 1, "known_from": r["known_from"], "known_to": r["known_to"]})
    ref.load_specs(spark, root, {"SIM": {"N": raw["SIM"]["N"][:1]}}, run_id="early")
    ref.load_specs(spark, root, raw, run_id="whole")
    return ref.stored_specs(spark, root).select("exchange", "symbol", "lot_size", "known_from", "known_to")


@query("j11_valid_as_of", f"""WITH {S.V_EOD}, {V_SPECS} SELECT e.exchange, e.symbol, e.expiry,
  e.trade_date, s.lot_size FROM v_eod e LEFT JOIN v_specs s ON s.exchange = e.exchange
  AND s.symbol = e.symbol AND s.known_from <= e.trade_date AND s.known_to >= e.trade_date""")
def j11(spark, sf):
    facts = S.eod(spark, sf).select("exchange", "symbol", "expiry", "trade_date")
    return V.valid_as_of(facts, specs(spark, sf), ["exchange", "symbol"], "trade_date",
                         ["lot_size"])


@query("j12_notional", f"""WITH {S.V_EOD}, {V_SPECS} SELECT e.exchange, e.symbol, e.expiry,
  e.trade_date, round(e.close * s.lot_size * 2, 4) AS notional FROM v_eod e
  JOIN v_specs s ON s.exchange = e.exchange
  AND s.symbol = e.symbol AND s.known_from <= e.trade_date AND s.known_to >= e.trade_date""")
def j12(spark, sf):
    """Facts that a specification covers; one without any would stop the query."""
    covered = "trade_date >= '1996-01-01' AND (symbol <> 'R' OR trade_date <= '1997-12-31')"
    facts = S.eod(spark, sf).where(covered).select("exchange", "symbol", "expiry", "trade_date",
                                                   F.col("close").alias("price"), F.lit(2.0).alias("lots"))
    return V.notional(facts, specs(spark, sf)).select("exchange", "symbol", "expiry", "trade_date",
                                                      F.round("notional", 4).alias("notional"))
