"""Quality checks over the gated sample rows, and vendor scores."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.operators import calendar as K
from tidemark.operators import checks as Q
from tidemark.operators import contract as C
from tidemark.plans.queries_calendar import CAL, calendar_sql, sample_calendar
from tidemark.plans.queries_gate import RAW, TOTALS, gated
from tidemark.plans.registry import query
from tidemark.session import written
from tidemark.sources import samples as S

CHECK = ["check_name", "status", "measure", "rows_in", "rows_out"]


def shown(check, digits: int = 6):
    return check.select("check_name", "status", F.round("measure", digits).alias("measure"),
                        "rows_in", "rows_out")


def check_sql(name: str, status: str, measure: str, rows_in: str, rows_out: str) -> str:
    return (f"SELECT '{name}' AS check_name, {status} AS status, "
            f"round(CAST({measure} AS DOUBLE), 6) AS measure, "
            f"CAST({rows_in} AS BIGINT) AS rows_in, CAST({rows_out} AS BIGINT) AS rows_out")


@query("q1_contract_check", f"""{RAW}, {TOTALS} {check_sql(
    'contract', "CASE WHEN null_rejected / rows > 0.02 OR rejected / rows > 0.5 THEN 'fail' "
    "WHEN rejected > 0 THEN 'warn' ELSE 'pass' END", 'rejected', 'clean + rejected', 'clean')}
  FROM t""")
def q1(spark, sf):
    return shown(Q.check_contract(gated(spark, sf).verdict()))


@query("h3_top_reject_reasons", f"""{RAW} SELECT reason, count(*) AS rows FROM v_gated
  WHERE reason IS NOT NULL GROUP BY reason ORDER BY rows DESC, reason LIMIT 3""")
def h3(spark, sf):
    return Q.top_reasons(gated(spark, sf).rejected)


@query("q2_uniqueness", f"""{RAW}, {TOTALS} {check_sql(
    'uniqueness', "CASE WHEN rows - rejected - clean > 0 THEN 'warn' ELSE 'pass' END",
    'rows - rejected - clean', 'clean + rejected', 'clean')} FROM t""")
def q2(spark, sf):
    return shown(Q.check_uniqueness(gated(spark, sf).verdict()))


SHUFFLED_IDS = f"""{S.V_TRADES}, s AS (
  SELECT venue, symbol, ts, CASE WHEN trade_id % 13 = 0 THEN trade_id - 40 ELSE trade_id END
           AS trade_id FROM v_trades),
 d AS (SELECT symbol, trade_id - lag(trade_id) OVER (PARTITION BY symbol ORDER BY ts, trade_id)
              AS step FROM s)"""


def shuffled_ids(spark, sf):
    i = F.col("trade_id")
    return S.trades(spark, sf).withColumn("trade_id", F.when(i % 13 == 0, i - 40).otherwise(i))


@query("q3_monotonic_trade_id", f"""WITH {SHUFFLED_IDS} {check_sql(
    'monotonic_trade_id', "CASE WHEN count(*) FILTER (step < 0) > 0 THEN 'warn' ELSE 'pass' END",
    'count(*) FILTER (step < 0)', 'count(*)', 'count(*)')} FROM d""")
def q3(spark, sf):
    return shown(Q.check_monotonic_id(shuffled_ids(spark, sf)))


@query("g18_out_of_order_ids", f"""WITH {SHUFFLED_IDS}
  SELECT symbol, count(*) FILTER (step < 0) AS out_of_order FROM d GROUP BY symbol""")
def g18(spark, sf):
    return Q.out_of_order_ids(shuffled_ids(spark, sf))


GAPS = """g AS (SELECT count(*) AS rows, count(DISTINCT date_trunc('minute', ts)) AS with_prints,
  date_diff('minute', min(date_trunc('minute', ts)), max(date_trunc('minute', ts))) + 1 AS span
  FROM v_clean)"""


@query("q4_gap_scan", f"""{RAW}, {GAPS} {check_sql(
    'gap_scan', "CASE WHEN span > with_prints THEN 'warn' ELSE 'pass' END", 'span - with_prints',
    'rows', 'rows')} FROM g""")
def q4(spark, sf):
    return shown(Q.check_gaps(gated(spark, sf).clean))


@query("a10_distinct_minutes", f"""{RAW}, {GAPS} SELECT *, span - with_prints AS missing FROM g""")
def a10(spark, sf):
    return Q.minute_gaps(gated(spark, sf).clean)


def _age_sql(now: str) -> str:
    return (f"greatest(date_diff('microsecond', max(ts), TIMESTAMP '{now}') "
            "/ CAST(1000000 AS DOUBLE), 0)")


@query("q5_freshness", f"""{RAW} {check_sql(
    'freshness', f"CASE WHEN {_age_sql(S.NOW)} <= 120 THEN 'pass' ELSE 'fail' END",
    _age_sql(S.NOW), 'count(*)', 'count(*)')} FROM v_clean""")
def q5(spark, sf):
    return shown(Q.check_freshness(gated(spark, sf).clean, "ts", now=S.NOW, sla_seconds=120))


EOD_NOW = "2001-11-06 21:00:00"


@query("q6_freshness_calendar", f"""WITH {S.V_EOD}, {calendar_sql(after=10)},
  due AS (SELECT max(day) AS due FROM v_calendar WHERE is_trading_day
          AND day BETWEEN DATE '2001-10-27' AND DATE '2001-11-06'
          AND TIMESTAMP '{EOD_NOW}' > deadline + INTERVAL 30 MINUTE)
  {check_sql('freshness', "CASE WHEN max(trade_date) >= due THEN 'pass' ELSE 'fail' END",
             "date_diff('day', max(trade_date), due)", 'count(*)', 'count(*)')}
  FROM v_eod, due GROUP BY due""")
def q6(spark, sf):
    eod = S.eod(spark, sf)
    holidays = K.day_spine(eod, "trade_date", 0, 10).where(F.dayofmonth("day") == 15).select(
        "day", F.lit("mid-month").alias("holiday"))
    due = K.expected_days(spark, CAL, holidays, now=EOD_NOW, lookback=10)
    return shown(Q.check_freshness_calendar(eod, "trade_date", due))


@query("q7_freshness_backfill", f"""{RAW} {check_sql(
    'freshness', "'pass'", '0', 'count(*)', 'count(*)')} FROM v_clean""")
def q7(spark, sf):
    return shown(Q.check_freshness(gated(spark, sf).clean, "ts", now=S.NOW, mode="backfill"))


EOD_CONTRACT = C.Contract.from_dict({
    "dataset": "sim_eod", "schema_version": "1.0",
    "grain": ["exchange", "symbol", "expiry", "trade_date"], "event_time_column": "trade_date",
    "columns": [
        {"name": "exchange", "type": "string", "required": True, "allowed": ["SIM"]},
        {"name": "symbol", "type": "string", "required": True},
        {"name": "expiry", "type": "date", "required": True},
        {"name": "trade_date", "type": "date", "required": True},
        *[{"name": n, "type": "float", "required": True, "min": 0}
          for n in ("open", "high", "low", "close", "volume")]],
    "rules": {"cross_field": [
        {"name": "range_not_negative", "expr": "high - low >= 0"},
        {"name": "prices_inside_range", "expr": "(least(open, close) - low >= 0) & (high - greatest(open, close) >= 0)"},
        {"name": "traded_before_expiry", "expr": "datediff(expiry, trade_date) >= 0"}]}})

V_EOD_GATED = f"""{S.V_EOD}, e AS (
  SELECT *, dayofmonth(trade_date) = 7 AND open_interest > 3 AS bad FROM v_eod)"""


def gated_eod(spark, sf):
    """End-of-day rows with a wrong high on some days."""
    wrong = (F.dayofmonth("trade_date") == 7) & (F.col("open_interest") > 3)
    raw = S.eod(spark, sf).withColumn("high", F.when(wrong, F.col("low") - 1).otherwise(
        F.col("high")))
    return C.gate(raw, EOD_CONTRACT, now="2001-12-01", arrival=["ingested_at"])


@query("q8_volume_accounted", f"""WITH {V_EOD_GATED}, s AS (
  SELECT symbol, sum(volume) AS declared, coalesce(sum(volume) FILTER (NOT bad), 0) AS loaded
  FROM e GROUP BY symbol), w AS (
  SELECT max(abs(loaded - declared) / nullif(declared, 0)) * 100 AS worst FROM s)
  {check_sql('volume_accounted', "CASE WHEN worst <= 0 THEN 'pass' ELSE 'warn' END", 'worst',
             '(SELECT count(*) FROM e)', '(SELECT count(*) FROM e WHERE NOT bad)')} FROM w""")
def q8(spark, sf):
    g = gated_eod(spark, sf)
    return shown(Q.check_volume(g.clean, g.rejected))


@query("a9_volume_by_symbol", f"""WITH {V_EOD_GATED}
  SELECT symbol, sum(volume) AS declared, coalesce(sum(volume) FILTER (NOT bad), 0) AS loaded,
         round(abs(coalesce(sum(volume) FILTER (NOT bad), 0) - sum(volume)) / sum(volume), 8) AS share
  FROM e GROUP BY symbol""")
def a9(spark, sf):
    g = gated_eod(spark, sf)
    return Q.volume_share(g.clean, g.rejected).withColumn("share", F.round("share", 8))


HOLED = f"""{S.V_EOD}, h AS (SELECT * FROM v_eod WHERE NOT (symbol = 'N' AND day(trade_date) = 20)
  AND NOT (dayofmonth(trade_date) = 11 AND month(trade_date) = 6))"""


def holed_eod(spark, sf):
    """End-of-day rows with one symbol missing on some days and one whole day a year gone."""
    return S.eod(spark, sf).where(
        ~((F.col("symbol") == "N") & (F.dayofmonth("trade_date") == 20))
        & ~((F.dayofmonth("trade_date") == 11) & (F.month("trade_date") == 6)))


@query("q9a_missing_days", f"""WITH {HOLED}, {calendar_sql()}
  SELECT day FROM v_calendar WHERE is_trading_day
    AND day BETWEEN (SELECT min(trade_date) FROM h) AND (SELECT max(trade_date) FROM h)
    AND day NOT IN (SELECT trade_date FROM h)""")
def q9a(spark, sf):
    eod = holed_eod(spark, sf)
    return Q.missing_days(eod, sample_calendar(spark, sf))


@query("q9b_short_days", f"""WITH {HOLED}
  SELECT d.trade_date AS day, s.symbol FROM (SELECT DISTINCT trade_date FROM h) d
  CROSS JOIN (SELECT DISTINCT symbol FROM h) s
  ANTI JOIN h ON h.trade_date = d.trade_date AND h.symbol = s.symbol""")
def q9b(spark, sf):
    return Q.short_days(holed_eod(spark, sf))


@query("q9c_missing_symbols", f"""WITH {S.V_EOD} SELECT symbol FROM (VALUES ('A'), ('N'), ('Q'), ('Z'))
  w(symbol) WHERE symbol NOT IN (SELECT symbol FROM v_eod)""")
def q9c(spark, sf):
    return Q.missing_symbols(S.eod(spark, sf), ["A", "N", "Q", "Z"])


@query("q9_expected_coverage", f"""WITH {HOLED}, {calendar_sql()}, p AS (
  SELECT DISTINCT trade_date, symbol FROM h),
  short AS (SELECT count(*) AS n FROM (SELECT trade_date FROM p GROUP BY trade_date
            HAVING count(*) < (SELECT count(DISTINCT symbol) FROM p))),
  absent AS (SELECT count(*) AS n FROM v_calendar WHERE is_trading_day
    AND day BETWEEN (SELECT min(trade_date) FROM h) AND (SELECT max(trade_date) FROM h)
    AND day NOT IN (SELECT trade_date FROM h))
  {check_sql('expected_coverage', "CASE WHEN short.n + absent.n + 1 > 0 THEN 'fail' ELSE 'pass' END",
             'short.n + absent.n + 1', '(SELECT count(*) FROM h)', '(SELECT count(*) FROM h)')}
  FROM short, absent""")
def q9(spark, sf):
    return shown(Q.check_coverage(holed_eod(spark, sf), sample_calendar(spark, sf), ["A", "Q"]))


@query("q10_expect_rows_min", f"""{RAW} {check_sql(
    'expect_rows_min', "CASE WHEN count(*) >= 1000000000 THEN 'pass' ELSE 'fail' END", 'count(*)',
    'count(*)', 'count(*)')} FROM v_clean""")
def q10(spark, sf):
    return shown(Q.check_min_rows(gated(spark, sf).clean, 1_000_000_000))


@query("q11_completeness_vs_expected", f"""{RAW} {check_sql(
    'completeness_vs_expected', "CASE WHEN count(*) / 10000 >= 0.999 THEN 'pass' ELSE 'warn' END",
    'count(*) / 10000', '10000', 'count(*)')} FROM v_clean""")
def q11(spark, sf):
    return shown(Q.check_completeness(gated(spark, sf).clean, 10_000))


@query("q12_schema_version_gate", """SELECT event_type AS dataset,
  CASE WHEN count(*) FILTER (user_id % 3 = 1) > 0 THEN 'pass' ELSE 'fail' END AS status, false AS recorded
  FROM events GROUP BY event_type UNION ALL SELECT 'unseen', 'pass', true
  UNION ALL SELECT 'unreadable', 'fail', false""")
def q12(spark, sf):
    """The gate asked for version 1 of every dataset seen, of one never seen and of one whose history is lost."""
    seen = S.table(spark, sf, "events").select(
        F.col("event_type").alias("dataset"), (F.col("user_id") % 3).cast("string").alias("schema_version"),
        F.col("ts").alias("first_seen"))
    names = [r[0] for r in seen.select("dataset").distinct().collect()]
    found = [(d, *Q.schema_version_status("1", seen, d)[::2]) for d in names]
    found += [("unseen", *Q.schema_version_status("1", seen, "unseen")[::2]),
              ("unreadable", *Q.schema_version_status("1", None, "unreadable", readable=False)[::2])]
    return spark.createDataFrame(found, "dataset string, status string, recorded boolean")


REPORT = f"""{RAW}, {TOTALS}, r AS (
  SELECT 'contract' AS check_name, CASE WHEN null_rejected / rows > 0.02 OR rejected / rows > 0.5
    THEN 'fail' WHEN rejected > 0 THEN 'warn' ELSE 'pass' END AS status FROM t
  UNION ALL SELECT 'uniqueness',
    CASE WHEN rows - rejected - clean > 0 THEN 'warn' ELSE 'pass' END FROM t
  UNION ALL SELECT 'expect_rows_min', CASE WHEN clean >= 5 THEN 'pass' ELSE 'fail' END FROM t)"""


def small_report(spark, sf):
    g = gated(spark, sf)
    v = g.verdict()
    return Q.report([Q.check_contract(v), Q.check_uniqueness(v), Q.check_min_rows(g.clean, 5)])


@query("q13_publishable", f"""{REPORT} SELECT bool_and(status <> 'fail') AS publishable,
  count(*) FILTER (status = 'fail') AS failed, count(*) FILTER (status = 'warn') AS warned FROM r""")
def q13(spark, sf):
    return Q.publishable(small_report(spark, sf))


@query("q14_retired_alias", f"""WITH {V_EOD_GATED}
  SELECT 'volume_accounted' AS check_name, count(*) FILTER (NOT bad) AS rows_out FROM e
  UNION ALL SELECT 'expected_coverage', count(*) FILTER (NOT bad) FROM e""")
def q14(spark, sf):
    g = gated_eod(spark, sf)
    wanted = Q.expand_checks(["reconcile_totals"])
    run = {"volume_accounted": lambda: Q.check_volume(g.clean, g.rejected),
           "expected_coverage": lambda: Q.check_coverage(g.clean)}
    return Q.report([run[name]() for name in wanted]).select("check_name", "rows_out")


@query("q15_event_rows", f"""{REPORT} SELECT 'load-1' AS run_id, 'sim_trades' AS dataset,
  'sim' AS source, check_name, status, TIMESTAMP '{S.NOW}' AS event_at FROM r""")
def q15(spark, sf):
    return Q.event_rows(small_report(spark, sf), run_id="load-1", dataset="sim_trades",
                        source="sim", now=S.NOW).drop("rows_in", "rows_out", "detail")


LOADS = f"""{RAW}, loads AS (
  SELECT symbol AS source, count(*) FILTER (reason IS NULL) AS clean, count(reason) AS rejected,
         max(ts_v) FILTER (reason IS NULL) AS latest FROM v_gated GROUP BY symbol),
 sc AS (SELECT source,
   CASE WHEN date_diff('microsecond', latest, TIMESTAMP '{S.NOW}') / 1e6 > 600
        THEN least(1.0, 600 / (date_diff('microsecond', latest, TIMESTAMP '{S.NOW}') / 1e6))
        ELSE 1.0 END::DOUBLE AS f,
   clean / (clean + rejected) AS c, 1.0::DOUBLE - rejected / (clean + rejected) AS a FROM loads),
 scored AS (SELECT *, 0.4::DOUBLE * f + 0.4::DOUBLE * c + 0.2::DOUBLE * a AS s FROM sc)"""


def loads(spark, sf):
    ok = F.col(C.REASON).isNull()
    return gated(spark, sf).rows.groupBy(F.col("symbol").alias("source")).agg(
        F.count_if(ok).alias("clean"), F.count_if(~ok).alias("rejected"),
        F.max(F.when(ok, F.col("ts"))).alias("latest")).withColumn("target_seconds", F.lit(600))


@query("q16_vendor_score", f"""{LOADS} SELECT DATE '2024-01-31' AS as_of, source,
  round(f, 4) AS freshness, round(c, 4) AS completeness, round(a, 4) AS accuracy,
  round(s, 4) AS score, CASE WHEN s >= 0.95 THEN 'green' WHEN s >= 0.85 THEN 'amber' ELSE 'red' END
  AS status FROM scored""")
def q16(spark, sf):
    return Q.vendor_scores(loads(spark, sf), as_of=S.NOW)


@query("q16_vendor_score_backfill", f"""{LOADS} SELECT source, CAST(NULL AS DOUBLE) AS freshness,
  round((0.4::DOUBLE * c + 0.2::DOUBLE * a) / 0.6::DOUBLE, 4) AS score FROM scored""")
def q16b(spark, sf):
    return Q.vendor_scores(loads(spark, sf), as_of=S.NOW, mode="backfill").select(
        "source", "freshness", "score")


#: Scores per (source, day) from the share of large values; one row each.
V_SCORES = """v_scores AS (
  SELECT event_type AS source, CAST(ts AS DATE) AS as_of,
         round(avg(CASE WHEN value > 3 THEN 1.0 ELSE 0.5 END), 4) AS score,
         round(avg(CASE WHEN value > 6 THEN 1.0 ELSE 0.4 END), 4) AS freshness,
         max(ts) AS computed_at FROM events GROUP BY ALL)"""


def scores(spark, sf):
    v = F.col("value")
    return S.table(spark, sf, "events").groupBy(
        F.col("event_type").alias("source"), F.to_date("ts").alias("as_of")).agg(
        F.round(F.avg(F.when(v > 3, 1.0).otherwise(0.5)), 4).alias("score"),
        F.round(F.avg(F.when(v > 6, 1.0).otherwise(0.4)), 4).alias("freshness"),
        F.max("ts").alias("computed_at"))


@query("q17_degraded_sources", f"""WITH {V_SCORES}, l AS (SELECT * FROM v_scores
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY as_of DESC) = 1)
  SELECT * FROM l WHERE score < 0.96""")
def q17(spark, sf):
    return Q.degraded(scores(spark, sf), 0.96)


@query("q18_declared_matrix", """WITH ran AS (
  SELECT 'c' || CAST(user_id % 5 AS VARCHAR) AS check_name,
         CASE WHEN max(value) > 300 THEN 'fail' ELSE 'pass' END AS status FROM events GROUP BY 1),
  dec AS (SELECT 'c' || CAST(user_id % 8 + 2 AS VARCHAR) AS check_name FROM events GROUP BY 1)
  SELECT check_name, coalesce(status, 'pass') AS status, status IS NOT NULL AS evaluated,
         true AS declared FROM dec LEFT JOIN ran USING (check_name)
  UNION ALL SELECT check_name, status, true, false FROM ran ANTI JOIN dec USING (check_name)""")
def q18(spark, sf):
    e = S.table(spark, sf, "events")
    ran = e.groupBy(F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias(
        "check_name")).agg(F.when(F.max("value") > 300, "fail").otherwise("pass").alias("status"))
    declared = e.select(F.concat(F.lit("c"), (F.col("user_id") % 8 + 2).cast("string")).alias(
        "check_name")).distinct()
    return Q.declared_matrix(declared, ran)


@query("i2_distinct_union", f"WITH {HOLED} SELECT DISTINCT symbol FROM h")
def i2(spark, sf):
    return holed_eod(spark, sf).select("symbol").distinct()


@query("i3_set_difference", f"""WITH {HOLED} SELECT DISTINCT trade_date FROM v_eod
  EXCEPT SELECT trade_date FROM h""")
def i3(spark, sf):
    return S.eod(spark, sf).select("trade_date").subtract(
        holed_eod(spark, sf).select("trade_date"))


@query("i4_table_equality", f"""{RAW}, a AS (SELECT * FROM v_clean), b AS (
  SELECT * FROM v_clean WHERE trade_id % 1000 <> 7)
  SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_left,
         (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_right""")
def i4(spark, sf):
    from tidemark.sources.tables import difference
    # Stored once: deduplicated within the comparison, each task would sort both sides beside its groups.
    clean = written(gated(spark, sf).clean, "clean")
    return difference(clean, clean.where("trade_id % 1000 <> 7"))
