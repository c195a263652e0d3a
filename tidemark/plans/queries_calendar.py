"""Calendar queries over the span of the sample dates."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import calendar as K
from tidemark.plans.registry import query
from tidemark.sources import samples as S

#: Zone and clock of the sample calendar (fixed values); every 15th is a holiday.
CAL = K.TradingCalendar("sim", "Asia/Kolkata")
NIGHT = K.TradingCalendar("night", "Asia/Kolkata", session_open="18:00", session_close="02:30")


def sample_calendar(spark, sf, source: str = "lineitem", column: str = "l_shipdate", **pad):
    spine = K.day_spine(S.table(spark, sf, source), column, **pad)
    return K.classify(spine, CAL, sample_holidays(spine))


def sample_holidays(spine):
    return spine.where(F.dayofmonth("day") == 15).select("day", F.lit("mid-month").alias("holiday"))


def calendar_sql(source: str = "lineitem", column: str = "l_shipdate", before: int = 0,
                 after: int = 0, name: str = "v_calendar") -> str:
    return f"""{name} AS (
  SELECT day, why_closed, why_closed IS NULL AS is_trading_day,
         CAST(day AS TIMESTAMP) + INTERVAL '23:55' HOUR TO MINUTE - INTERVAL '5:30' HOUR TO MINUTE
           AS deadline
  FROM (SELECT day, CASE WHEN isodow(day) > 5 THEN 'weekend'
                         WHEN dayofmonth(day) = 15 THEN 'holiday: mid-month' END AS why_closed
        FROM (SELECT CAST(unnest(generate_series(
                CAST(min({column}) AS DATE) - INTERVAL {before} DAY,
                CAST(max({column}) AS DATE) + INTERVAL {after} DAY, INTERVAL 1 DAY)) AS DATE) AS day
              FROM {source})))""".replace("INTERVAL '23:55' HOUR TO MINUTE", "INTERVAL 1435 MINUTE").replace(
        "INTERVAL '5:30' HOUR TO MINUTE", "INTERVAL 330 MINUTE")


CS = f"WITH {calendar_sql()}"


@query("c1_trading_day", f"{CS} SELECT day, is_trading_day FROM v_calendar")
def c1(spark, sf):
    return sample_calendar(spark, sf).select("day", "is_trading_day")


@query("c2_closed_reason", f"{CS} SELECT day, why_closed FROM v_calendar WHERE NOT is_trading_day")
def c2(spark, sf):
    return sample_calendar(spark, sf).where("NOT is_trading_day").select("day", "why_closed")


@query("c3_previous_trading_day", f"""{CS} SELECT day, max(CASE WHEN is_trading_day THEN day END)
  OVER (ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS previous_trading_day
  FROM v_calendar""")
def c3(spark, sf):
    return K.previous_trading_day(sample_calendar(spark, sf)).select(
        "day", "previous_trading_day")


@query("c4_trading_days", f"{CS} SELECT day FROM v_calendar WHERE is_trading_day")
def c4(spark, sf):
    spine = K.day_spine(S.table(spark, sf, "lineitem"), "l_shipdate")
    return K.trading_days(spine, CAL, sample_holidays(spine))


@query("c5_delivery_deadline", f"{CS} SELECT day, deadline FROM v_calendar")
def c5(spark, sf):
    return sample_calendar(spark, sf).select("day", CAL.delivery_deadline("day").alias("deadline"))


@query("c6_overdue", f"""{CS} SELECT day,
  TIMESTAMP '2000-06-15 18:56:00' > deadline + INTERVAL 30 MINUTE AS overdue FROM v_calendar""")
def c6(spark, sf):
    return sample_calendar(spark, sf).select(
        "day", CAL.is_overdue("day", "2000-06-15 18:56:00").alias("overdue"))


@query("c7_expected_days", f"""{CS}, n AS (SELECT CAST(day AS TIMESTAMP) + INTERVAL 19 HOUR AS now_ts,
    day AS today FROM v_calendar)
  SELECT n.today, count(c.day) AS expected FROM n LEFT JOIN v_calendar c
    ON c.is_trading_day AND c.day BETWEEN n.today - INTERVAL 7 DAY AND n.today
    AND n.now_ts > c.deadline + INTERVAL 30 MINUTE GROUP BY n.today""")
def c7(spark, sf):
    """For each day of the span seen as today: how many deliveries of the last week were due."""
    cal = sample_calendar(spark, sf)
    asked = cal.select(F.col("day").alias("today"),
                       (F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 19 HOURS")).alias("at"),
                       F.explode(F.sequence(F.date_sub("day", 7), F.col("day"))).alias("day"))
    due = cal.where("is_trading_day").select("day", CAL.cutoff("day").alias("cutoff"))
    return asked.join(due, "day", "left").groupBy("today").agg(
        F.count_if(F.col("at") > F.col("cutoff")).alias("expected"))


@query("c8_session_bounds", f"""{CS} SELECT day,
  CASE WHEN is_trading_day THEN CAST(day AS TIMESTAMP) + INTERVAL 750 MINUTE END AS session_open,
  CASE WHEN is_trading_day THEN CAST(day AS TIMESTAMP) + INTERVAL 1260 MINUTE END AS session_close
  FROM v_calendar""")
def c8(spark, sf):
    return K.sessions(sample_calendar(spark, sf), NIGHT)


NIGHT_SQL = f"""WITH {calendar_sql('events', 'ts', 3, 3)}, s AS (
  SELECT day, CAST(day AS TIMESTAMP) + INTERVAL 750 MINUTE AS o,
         CAST(day AS TIMESTAMP) + INTERVAL 1260 MINUTE AS c FROM v_calendar WHERE is_trading_day),
 e AS (SELECT event_id, event_type, value, ts, s.day AS session_date FROM events
       LEFT JOIN s ON ts >= s.o AND ts < s.c)"""


def night_events(spark, sf):
    events = S.table(spark, sf, "events")
    return K.with_session(events, sample_calendar(spark, sf, "events", "ts", before=3, after=3),
                          NIGHT)


@query("c9_in_session", f"{NIGHT_SQL} SELECT event_id, session_date IS NOT NULL AS in_session FROM e")
def c9(spark, sf):
    return night_events(spark, sf).select("event_id", F.col("session_date").isNotNull().alias(
        "in_session"))


@query("c10_skip_reasons", f"{CS} SELECT coalesce(why_closed, 'open') AS reason, count(*) AS days "
       "FROM v_calendar GROUP BY 1")
def c10(spark, sf):
    return sample_calendar(spark, sf).groupBy(
        F.coalesce("why_closed", F.lit("open")).alias("reason")).agg(
        F.count(F.lit(1)).alias("days"))


@query("c11_partition_set", f"""{CS} SELECT day, strftime(day, '%Y-%m-%d') AS partition_key
  FROM v_calendar WHERE is_trading_day AND day >= (SELECT min(day) + 30 FROM v_calendar)""")
def c11(spark, sf):
    cal = sample_calendar(spark, sf)
    start = cal.agg(F.date_add(F.min("day"), 30)).scalar()
    return cal.where(F.col("is_trading_day") & (F.col("day") >= start)).select(
        "day", F.date_format("day", "yyyy-MM-dd").alias("partition_key"))


@query("c12_session_buckets", f"""{NIGHT_SQL} SELECT event_type, session_date, count(*) AS n,
  max(value) AS high, min(value) AS low FROM e WHERE session_date IS NOT NULL
  GROUP BY event_type, session_date""")
def c12(spark, sf):
    return night_events(spark, sf).where("session_date IS NOT NULL").groupBy(
        "event_type", "session_date").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("high"), F.min("value").alias("low"))
