"""Arrivals, cursors, alerts, figures and entitlements."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.times import HOUR, bar_start, floor_to, from_micros, micros
from tidemark.operators import alerts as L
from tidemark.operators import asof as A
from tidemark.operators import bars as B
from tidemark.operators import calendar as K
from tidemark.operators import checks as Q
from tidemark.operators import cursors as U
from tidemark.operators import deliveries as D
from tidemark.operators import entitlements as N
from tidemark.operators import monitor as M
from tidemark.plans.queries_bars import bar_sql
from tidemark.plans.queries_calendar import CAL, calendar_sql, sample_calendar
from tidemark.plans.queries_checks import HOLED, V_SCORES, holed_eod, scores
from tidemark.plans.queries_joins import BASE, asof_sql
from tidemark.plans.registry import query
from tidemark.sources import samples as S

WANTED = ["A", "N", "R"]
NOW = "2024-01-25 12:00:00"

# ---- arrivals ----------------------------------------------------------------------
DUE = f"""WITH {HOLED}, {calendar_sql()}, due AS (SELECT day, deadline FROM v_calendar
  WHERE is_trading_day), want AS (SELECT day, deadline, s.symbol FROM due,
  (VALUES ('A'), ('N'), ('R')) s(symbol)),
 miss AS (SELECT w.* FROM want w ANTI JOIN h ON h.trade_date = w.day AND h.symbol = w.symbol)"""


def due_days(spark, sf):
    return sample_calendar(spark, sf).where("is_trading_day").select("day")


@query("j15_missing_arrivals", f"{DUE} SELECT day, symbol FROM miss")
def j15(spark, sf):
    return M.missing_arrivals(due_days(spark, sf), M.arrivals_per_day(holed_eod(spark, sf)), WANTED)


@query("k14_arrival_gaps", f"""{DUE}, found AS (SELECT trade_date AS day, count(*) AS n FROM h GROUP BY 1),
  m AS (SELECT day, string_agg(symbol, ',' ORDER BY symbol) AS missing FROM miss GROUP BY day)
  SELECT d.day, d.deadline, coalesce(n, 0) AS rows_found, missing,
    CASE WHEN n IS NULL THEN 'nothing' ELSE 'partial' END AS kind
  FROM due d LEFT JOIN found USING (day) LEFT JOIN m USING (day)
  WHERE n IS NULL OR missing IS NOT NULL""")
def k14(spark, sf):
    out = M.gaps(due_days(spark, sf), holed_eod(spark, sf), CAL, WANTED)
    return out.select("day", "deadline", "rows_found", "kind",
                      F.array_join("missing_symbols", ",").alias("missing"))


@query("a8_arrivals_per_day", f"""WITH {HOLED} SELECT trade_date AS day, symbol, count(*) AS rows
  FROM h GROUP BY ALL UNION ALL SELECT trade_date, NULL, count(*) FROM h GROUP BY trade_date""")
def a8(spark, sf):
    eod = holed_eod(spark, sf)
    return M.arrivals_per_day(eod).unionByName(M.arrivals_per_day(eod, symbol=None))


SEEN = f"""WITH {calendar_sql()}, seen AS (SELECT CAST(l_shipdate AS DATE) AS day,
    CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 1105 MINUTE
      + to_minutes(CAST(sum(l_linenumber) % 260 - 30 AS BIGINT)) AS available_at
  FROM lineitem WHERE dayofmonth(l_shipdate) <> 9 GROUP BY 1),
 p AS (SELECT c.*, s.available_at, CAST(ceil(greatest(
         date_diff('microsecond', deadline, available_at), 0) / 9e8) AS BIGINT) AS polls
       FROM v_calendar c LEFT JOIN seen s USING (day)),
 st AS (SELECT *, CASE WHEN NOT is_trading_day THEN 'skipped'
     WHEN available_at IS NULL OR polls > 8 THEN 'missing' WHEN polls <= 2 THEN 'on_time'
     ELSE 'late' END AS status FROM p)"""


def first_seen(spark, sf):
    """Arrival times spread around the deadline; the ninth never arrives."""
    day = F.to_date("l_shipdate")
    return S.table(spark, sf, "lineitem").where(F.dayofmonth("l_shipdate") != 9).groupBy(
        day.alias("day")).agg((F.sum("l_linenumber") % 260 - 30).alias("m")).select(
        "day", F.timestamp_micros(
            F.unix_micros(F.col("day").cast("timestamp")) + (F.col("m") + 1105) * 60_000_000
        ).cast("timestamp_ntz").alias("available_at"))


@query("k13_arrival_status", f"""{SEEN} SELECT day, status, deadline,
  CASE status WHEN 'skipped' THEN 0 WHEN 'missing' THEN 9 ELSE polls + 1 END::BIGINT AS attempts,
  CASE WHEN status IN ('on_time', 'late') THEN deadline + to_minutes(polls * 15) END AS arrived_at,
  CASE WHEN status IN ('on_time', 'late') THEN polls * 900 ELSE 0 END::DOUBLE AS delay_seconds
  FROM st""")
def k13(spark, sf):
    return M.arrival_status(sample_calendar(spark, sf), first_seen(spark, sf), CAL)


@query("k13_timeliness", f"""{SEEN} SELECT CASE status WHEN 'late' THEN 'warn' WHEN 'missing' THEN 'fail'
  ELSE 'pass' END AS status, count(*) AS days FROM st GROUP BY 1""")
def k13b(spark, sf):
    out = M.arrival_status(sample_calendar(spark, sf), first_seen(spark, sf), CAL)
    return M.timeliness_events(out).groupBy("status").agg(F.count(F.lit(1)).alias("days"))


@query("s11_backfill_report", f"""WITH {HOLED}, {calendar_sql()}, f AS (
  SELECT trade_date AS day, count(*) AS rows FROM h GROUP BY 1),
  w AS (SELECT day, rows, CASE WHEN day > DATE '2001-10-10' THEN 'in the future'
    WHEN why_closed IS NOT NULL THEN why_closed
    WHEN day = DATE '2001-10-10' THEN 'not published yet, due {CAL.deadline}' END AS why
    FROM v_calendar c LEFT JOIN f USING (day))
  SELECT day, coalesce(why, CASE WHEN rows IS NULL THEN 'nothing published' ELSE 'fetched' END) AS outcome,
    CASE WHEN why IS NULL THEN rows END AS rows FROM w""")
def s11(spark, sf):
    return M.backfill_report(sample_calendar(spark, sf), M.arrivals_per_day(holed_eod(spark, sf)), CAL,
                             "2001-10-10 08:00:00")


@query("s12_backfill_plan", f"""WITH {HOLED}, {calendar_sql()} SELECT c.day, s.symbol FROM v_calendar c
  CROSS JOIN (VALUES ('A'), ('N'), ('R')) s(symbol) ANTI JOIN h ON h.trade_date = c.day AND h.symbol = s.symbol
  WHERE c.is_trading_day AND c.day <= DATE '2001-01-31'""")
def s12(spark, sf):
    loaded = holed_eod(spark, sf).select(F.col("trade_date").alias("day"), "symbol")
    return M.backfill_plan(sample_calendar(spark, sf), loaded, "2001-01-31", WANTED).select("day", "symbol")


# ---- cursors -----------------------------------------------------------------------
V_CURSORS = """v_cursors AS (SELECT event_type AS source, ts - INTERVAL 90 SECOND AS position_ts,
  event_id AS position_id, ts AS updated_at FROM events WHERE event_type <> 'view')"""


def cursors(spark, sf):
    return S.table(spark, sf, "events").where("event_type <> 'view'").select(
        F.col("event_type").alias("source"),
        (F.col("ts") - F.expr("INTERVAL 90 SECONDS")).alias("position_ts"),
        F.col("event_id").alias("position_id"), F.col("ts").alias("updated_at"))


AT = f"""{V_CURSORS}, pos AS (SELECT * FROM v_cursors
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY updated_at DESC) = 1)"""


@query("k1_cursor_position", f"WITH {AT} SELECT * FROM pos")
def k1(spark, sf):
    return U.positions(cursors(spark, sf))


WINDOWS = f"""{AT}, win AS (SELECT DISTINCT e.event_type AS source,
    coalesce(pos.position_ts - INTERVAL 5 SECOND, TIMESTAMP '{S.NOW}' - INTERVAL 1 HOUR)
      AS window_start, TIMESTAMP '{S.NOW}' AS window_end, pos.position_ts IS NULL AS cold_start
  FROM events e LEFT JOIN pos ON pos.source = e.event_type)"""


def asked(spark, sf):
    sources = S.table(spark, sf, "events").select(F.col("event_type").alias("source"))
    return U.windows(sources, cursors(spark, sf), now=S.NOW)


@query("k2_cursor_window", f"WITH {WINDOWS} SELECT * FROM win")
def k2(spark, sf):
    return asked(spark, sf)


@query("k3_cursor_advance", f"""WITH {S.V_TRADES} SELECT symbol AS source,
  least(max(ts), TIMESTAMP '2024-01-30 23:30:00') AS position_ts, max(trade_id) AS position_id,
  count(*) AS rows_at_position, TIMESTAMP '{S.NOW}' AS updated_at FROM v_trades GROUP BY symbol""")
def k3(spark, sf):
    return U.advance(S.trades(spark, sf), window_end="2024-01-30 23:30:00", updated_at=S.NOW,
                     source="symbol")


@query("s9_incremental_window", f"""WITH {S.V_TRADES}, {WINDOWS}
  SELECT t.* FROM v_trades t JOIN win ON win.source = t.symbol
  WHERE t.ts >= window_start - INTERVAL 0 SECOND AND t.ts <= window_end""")
def s9(spark, sf):
    return U.incremental_rows(S.trades(spark, sf), asked(spark, sf), "symbol")


@query("k10_retry_ledger", """SELECT 'f' || CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE)
    AS VARCHAR) AS fingerprint, bool_or(value > 50) AS ok,
  count(*) FILTER (NOT value > 50) AS failed_attempts,
  bool_or(value > 50) OR count(*) FILTER (NOT value > 50) >= 3 AS settled
  FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def k10(spark, sf):
    attempts = S.table(spark, sf, "events").select(
        F.concat_ws("-", F.concat(F.lit("f"), F.col("user_id").cast("string")),
                    F.to_date("ts").cast("string")).alias("fingerprint"),
        (F.col("value") > 50).alias("ok"))
    return D.ledger_state(attempts)


DELIVERIES = """dl AS (SELECT event_id, event_type AS source, ts AS file_time,
  ts + INTERVAL 2 SECOND AS detected_at,
  ts + INTERVAL 2 SECOND + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) AS queryable_at
  FROM events)"""


def deliveries(spark, sf):
    d = S.table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("source"), F.col("ts").alias("file_time"),
        (F.col("ts") + F.expr("INTERVAL 2 SECONDS")).alias("detected_at"), "value")
    late = F.timestamp_micros(F.unix_micros(F.col("detected_at").cast("timestamp"))
                              + F.round(F.col("value") * 1000).cast("bigint") * 1000)
    return d.withColumn("queryable_at", late.cast("timestamp_ntz")).drop("value")


LATENCY = f"""{DELIVERIES}, lt AS (SELECT *,
  date_diff('microsecond', file_time, queryable_at) / 1e6 AS total FROM dl)"""


@query("k12_delivery_latency", f"""WITH {LATENCY} SELECT event_id, source, round(total, 3) AS total_seconds,
  CASE WHEN total < 60 THEN 'pass' ELSE 'warn' END AS status FROM lt""")
def k12(spark, sf):
    return D.latency_events(deliveries(spark, sf)).select(
        "event_id", "source", F.round("total_seconds", 3).alias("total_seconds"), "status")


@query("a15_latency_stats", f"""WITH {LATENCY} SELECT source, count(*) AS deliveries,
  round(max(total), 2) AS worst, count(*) FILTER (round(total, 2) > 60) AS over_sla
  FROM lt GROUP BY source""")
def a15(spark, sf):
    logged = D.logged_latency(D.latency_events(deliveries(spark, sf)))
    return logged.groupBy("source").agg(
        F.count(F.lit(1)).alias("deliveries"), F.max("seconds").alias("worst"),
        F.count_if("over").alias("over_sla"))


@query("o3_latency_per_delivery", f"""WITH {LATENCY} SELECT event_id, source,
  round(total, 2) AS seconds FROM lt""")
def o3(spark, sf):
    return D.logged_latency(D.latency_events(deliveries(spark, sf))).select(
        "event_id", "source", "seconds")


# ---- alerts ------------------------------------------------------------------------
V_EVENTS = """v_quality AS (SELECT event_id AS run_id, event_type AS source,
  'c' || CAST(user_id % 5 AS VARCHAR) AS check_name,
  CASE WHEN value > 60 THEN 'fail' WHEN value > 6 THEN 'warn' ELSE 'pass' END AS status,
  ts AS event_at FROM events)"""


def quality_events(spark, sf):
    v = F.col("value")
    return S.table(spark, sf, "events").select(
        F.col("event_id").alias("run_id"), F.col("event_type").alias("source"),
        F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("check_name"),
        F.when(v > 60, "fail").when(v > 6, "warn").otherwise("pass").alias("status"),
        F.col("ts").alias("event_at"))


@query("l1_eod_late", f"""WITH {S.V_EOD}, {calendar_sql(after=10)}, d AS (
    SELECT max(day) AS trading_day, max(deadline) AS deadline FROM v_calendar
    WHERE is_trading_day AND day <= DATE '2001-11-09'),
  w AS (SELECT min(m) AS newest_bar FROM (SELECT max(trade_date) AS m FROM v_eod GROUP BY symbol))
  SELECT trading_day, newest_bar, date_diff('second', CAST(newest_bar AS TIMESTAMP), deadline)
    ::DOUBLE AS behind_seconds,
    date_diff('second', CAST(newest_bar AS TIMESTAMP), deadline) > 86400
    AND date_diff('second', deadline, TIMESTAMP '2001-11-09 20:00:00') > 1800 AS firing FROM d, w""")
def l1(spark, sf):
    cal = sample_calendar(spark, sf, after=10)
    return L.eod_late(S.eod(spark, sf), cal, CAL, now="2001-11-09 20:00:00")


@query("l2_feed_stalled", f"""WITH {AT} SELECT source,
  greatest(date_diff('microsecond', position_ts, TIMESTAMP '{S.NOW}') / 1e6, 0) AS position_age_seconds,
  greatest(date_diff('microsecond', updated_at, TIMESTAMP '{S.NOW}') / 1e6, 0) AS idle_seconds,
  date_diff('microsecond', updated_at, TIMESTAMP '{S.NOW}') / 1e6 > 600 AS firing FROM pos""")
def l2(spark, sf):
    return L.feed_stalled(cursors(spark, sf), now=S.NOW)


@query("l3_failed_checks", f"""WITH {V_EVENTS} SELECT source, check_name, count(*) AS failures
  FROM v_quality WHERE status = 'fail' AND event_at > TIMESTAMP '{NOW}' - INTERVAL 3 DAY
  AND event_at <= TIMESTAMP '{NOW}' GROUP BY ALL""")
def l3(spark, sf):
    return L.failed_checks(quality_events(spark, sf), now=NOW, minutes=3 * 1440)


@query("l4_warn_rate_rising", f"""WITH {V_EVENTS}, ev AS (
    SELECT source, epoch_us(event_at) AS u FROM v_quality WHERE status = 'warn'),
  grid AS (SELECT source, u - u % 300000000 + (k + 1) * 300000000 AS e FROM ev, range(12) r(k)),
  cnt AS (SELECT source, e, count(*) AS n FROM grid GROUP BY ALL HAVING count(*) > 2),
  runs AS (SELECT *, e - row_number() OVER (PARTITION BY source ORDER BY e) * 300000000 AS g FROM cnt)
  SELECT source, make_timestamp(min(e)) AS since, make_timestamp(max(e)) AS until, max(n) AS peak
  FROM runs GROUP BY source, g HAVING max(e) - min(e) >= 1800000000""")
def l4(spark, sf):
    return L.warn_rate_rising(quality_events(spark, sf), ["source"], threshold=2)


SIX = """six AS (SELECT event_type AS source, time_bucket(INTERVAL 6 HOUR, ts) AS computed_at,
  round(avg(CASE WHEN value > 3 THEN 1.0 ELSE 0.4 END), 4) AS score FROM events GROUP BY ALL)"""


def below_sql(threshold: float, minutes: int, severity: str) -> str:
    return f"""SELECT s.source, '{severity}' AS severity, min(computed_at) AS since,
  arg_max(score, computed_at) AS score FROM six s JOIN (
    SELECT source, max(computed_at) FILTER (score >= {threshold}) AS ok FROM six GROUP BY source) o
  ON o.source = s.source WHERE ok IS NULL OR computed_at > ok GROUP BY s.source
  HAVING date_diff('second', min(computed_at), TIMESTAMP '{S.NOW}') >= {minutes * 60}"""


@query("l5_vendor_alerts", f"""WITH {SIX} {below_sql(0.98, 60, 'warn')}
  UNION ALL {below_sql(0.9, 15, 'page')}""")
def l5(spark, sf):
    v = F.col("value")
    hourly = S.table(spark, sf, "events").groupBy(
        F.col("event_type").alias("source"), from_micros(floor_to(
            micros("ts"), 6 * HOUR)).alias("computed_at")).agg(
        F.round(F.avg(F.when(v > 3, 1.0).otherwise(0.4)), 4).alias("score"))
    return L.vendor_alerts(hourly, now=S.NOW, warn=0.98, page=0.9)


@query("l6_deadline_clock", f"""WITH {calendar_sql()}, b AS (SELECT *, CASE WHEN is_trading_day THEN day
    ELSE max(CASE WHEN is_trading_day THEN day END) OVER (ORDER BY day
      ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) END AS latest_day FROM v_calendar)
  SELECT day, is_trading_day, latest_day, date_diff('second', CAST(day AS TIMESTAMP) + INTERVAL 12 HOUR,
    CAST(latest_day AS TIMESTAMP) + INTERVAL 1105 MINUTE)::DOUBLE AS seconds_to_deadline FROM b""")
def l6(spark, sf):
    return L.deadline_clock(sample_calendar(spark, sf), CAL)


@query("l7_alert_rows", f"""{DUE}, {V_SCORES}, found AS (SELECT DISTINCT trade_date AS day FROM h),
  g AS (SELECT DISTINCT d.day, f.day IS NULL AS nothing FROM due d LEFT JOIN found f ON f.day = d.day
        LEFT JOIN miss m ON m.day = d.day WHERE f.day IS NULL OR m.day IS NOT NULL),
  l AS (SELECT * FROM v_scores
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY as_of DESC) = 1)
  SELECT 'eod' AS source, 'page' AS severity, CASE WHEN nothing THEN 'DeliveryMissing'
    ELSE 'DeliveryIncomplete' END AS alert, CAST(day AS VARCHAR) AS incident FROM g
  UNION ALL SELECT source, 'warn', 'SourceDegraded', CAST(as_of AS VARCHAR) FROM l
    WHERE score < 0.96""")
def l7(spark, sf):
    g = M.gaps(due_days(spark, sf), holed_eod(spark, sf), CAL, WANTED)
    return L.gap_alerts(g, "eod").unionByName(
        L.score_alerts(Q.degraded(scores(spark, sf), 0.96)))


@query("l8_dashboard", f"""WITH {V_EVENTS}, {AT}
  SELECT 'fails_24h' AS panel, count(*)::DOUBLE AS value FROM v_quality WHERE status = 'fail'
    AND event_at > TIMESTAMP '{NOW}' - INTERVAL 1 DAY AND event_at <= TIMESTAMP '{NOW}'
  UNION ALL SELECT 'rows_trades', count(*)::DOUBLE FROM events
  UNION ALL SELECT 'worst_idle_seconds',
    max(greatest(date_diff('microsecond', updated_at, TIMESTAMP '{NOW}') / 1e6, 0)) FROM pos""")
def l8(spark, sf):
    return L.dashboard(quality_events(spark, sf), S.trades(spark, sf), cursors(spark, sf), now=NOW)


@query("l8_statuses_over_time", f"""WITH {V_EVENTS} SELECT time_bucket(INTERVAL 15 MINUTE, event_at)
  AS bucket, status, count(*) AS n FROM v_quality GROUP BY ALL""")
def l8b(spark, sf):
    return L.statuses_over_time(quality_events(spark, sf))


# ---- figures -----------------------------------------------------------------------
@query("a4_catalog", f"""WITH {S.V_TRADES}, {S.V_EOD}
  SELECT 'trades' AS dataset, symbol, count(*) AS rows, min(ts) AS first_event, max(ts) AS last_event
    FROM v_trades GROUP BY symbol
  UNION ALL SELECT 'eod_bars', symbol, count(*), CAST(min(trade_date) AS TIMESTAMP),
    CAST(max(trade_date) AS TIMESTAMP) FROM v_eod GROUP BY symbol""")
def a4(spark, sf):
    from tidemark.plans.serve import catalog
    return catalog({"trades": (S.trades(spark, sf), "ts"),
                    "eod_bars": (S.eod(spark, sf), "trade_date")})


@query("a5_rows_and_age", f"""WITH {S.V_TRADES} SELECT 'trades' AS dataset, symbol, count(*) AS rows,
  round(greatest(date_diff('microsecond', max(ts), TIMESTAMP '{S.NOW}') / 1e6, 0), 1) AS age_seconds
  FROM v_trades GROUP BY symbol""")
def a5(spark, sf):
    return L.rows_and_age(S.trades(spark, sf), "trades", "ts", now=S.NOW)


@query("a6_check_outcomes", f"""WITH {V_EVENTS} SELECT source, check_name, status, count(*) AS n
  FROM v_quality GROUP BY ALL""")
def a6(spark, sf):
    return L.check_outcomes(quality_events(spark, sf))


@query("a7_outcome_pivot", f"""WITH {V_EVENTS} SELECT check_name,
  count(*) FILTER (status = 'pass') AS pass, count(*) FILTER (status = 'warn') AS warn,
  count(*) FILTER (status = 'fail') AS fail, count(*) AS total FROM v_quality GROUP BY check_name""")
def a7(spark, sf):
    return L.outcome_pivot(quality_events(spark, sf))


@query("g14_latest_per_source", f"""WITH {V_SCORES} SELECT * FROM v_scores
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY as_of DESC) = 1""")
def g14(spark, sf):
    return Q.latest_by(scores(spark, sf), ["source"], "as_of")


@query("o4_vendor_scorecard", f"""WITH {V_SCORES} SELECT source, as_of, score, freshness FROM v_scores
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY as_of DESC) = 1""")
def o4(spark, sf):
    return Q.latest_by(scores(spark, sf), ["source"], "as_of").select(
        "source", "as_of", "score", "freshness")


@query("h2_newest_log_rows", f"""WITH {V_EVENTS} SELECT * FROM v_quality
  ORDER BY event_at DESC LIMIT 20""")
def h2(spark, sf):
    return L.newest_rows(quality_events(spark, sf), 20)


@query("h6_score_listing", f"""WITH {V_SCORES} SELECT source, as_of, score,
  row_number() OVER (PARTITION BY as_of ORDER BY source) AS place FROM v_scores""")
def h6(spark, sf):
    from pyspark.sql import Window
    listed = scores(spark, sf).orderBy(F.desc("as_of"), "source")
    return listed.select("source", "as_of", "score", F.row_number().over(
        Window.partitionBy("as_of").orderBy("source")).cast("bigint").alias("place"))


@query("h7_every_kth_decision", f"""WITH {S.V_REPLAY}, {bar_sql('v_latest', 60)}
  SELECT venue, symbol, bucket + INTERVAL 17500 MILLISECOND AS query_ts FROM b
  QUALIFY (row_number() OVER (PARTITION BY venue, symbol ORDER BY bucket) - 1) % 7 = 0""")
def h7(spark, sf):
    grid = A.decision_grid(B.ohlcv(S.replay(spark, sf), "1m"))
    return A.every_kth(grid, 7)


@query("o5_prints_and_ranges", f"""{BASE}, {asof_sql('v_decisions', 'v_latest')},
  {bar_sql('v_latest', 60)}, ag AS (SELECT symbol, date_trunc('minute', query_ts) AS bucket,
    max(date_diff('microsecond', trade_ts, query_ts) / 1e6) AS worst FROM m GROUP BY ALL)
  SELECT b.symbol, b.bucket, b.trades AS prints, round(b.high - b.low, 6) AS price_range,
    round(ag.worst, 6) AS worst_staleness FROM b LEFT JOIN ag USING (symbol, bucket)""")
def o5(spark, sf):
    prints = S.replay(spark, sf)
    bars = B.ohlcv(prints, "1m")
    marks = A.with_staleness(A.asof_join(S.decisions(spark, sf), prints, version="ingested_at")).groupBy(
        "symbol", bar_start("query_ts", "1m").alias("bucket")).agg(
        F.max("staleness_seconds").alias("worst"))
    return bars.join(marks, ["symbol", "bucket"], "left").select(
        "symbol", "bucket", F.col("trades").alias("prints"),
        F.round(F.col("high") - F.col("low"), 6).alias("price_range"),
        F.round("worst", 6).alias("worst_staleness"))


# ---- entitlements ------------------------------------------------------------------
#: Sample policy (fixed values).
POLICY = N.Policy("user", {
    "eod": {"licence": "internal use", "allow": ["user", "system"]},
    "ticks": {"licence": "per seat", "allow": ["system"]}},
    {"user": {}, "system": {}, "assistant": {"allow_nothing": True}})

ASKS = """asks AS (SELECT conv_id, turn, role AS consumer,
  CASE turn % 3 WHEN 0 THEN 'eod' WHEN 1 THEN 'ticks' ELSE 'unlisted' END AS dataset
  FROM conversations)"""


def requests(spark, sf):
    t = F.col("turn") % 3
    return S.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("role").alias("consumer"),
        F.when(t == 0, "eod").when(t == 1, "ticks").otherwise("unlisted").alias("dataset"))


DECIDED = f"""{ASKS}, decided AS (SELECT *,
  consumer <> 'assistant' AND ((dataset = 'eod' AND consumer IN ('user', 'system'))
    OR (dataset = 'ticks' AND consumer = 'system')) AS allowed,
  CASE WHEN consumer = 'assistant' THEN consumer || ' may read nothing'
       WHEN dataset = 'unlisted' THEN 'no rule for ' || dataset
       WHEN dataset = 'eod' AND consumer IN ('user', 'system') THEN 'internal use'
       WHEN dataset = 'ticks' AND consumer = 'system' THEN 'per seat'
       ELSE consumer || ' is not allowed ' || dataset END AS detail FROM asks)"""


@query("e1_entitlement_decisions", f"WITH {DECIDED} SELECT * FROM decided")
def e1(spark, sf):
    return N.decide(requests(spark, sf), POLICY)


@query("e2_audit_log", f"""WITH {DECIDED} SELECT TIMESTAMP '{NOW}' AS event_at, consumer, dataset,
  'read' AS action, allowed, detail FROM decided""")
def e2(spark, sf):
    return N.audit_rows(N.decide(requests(spark, sf), POLICY), now=NOW)
