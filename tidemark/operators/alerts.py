"""Alert conditions and dashboard figures as tables."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.times import MINUTE, SECOND, floor_to, from_micros, instant, micros
from tidemark.operators.calendar import TradingCalendar
from tidemark.operators.checks import latest_by


def seconds_between(late: Column, early: Column) -> Column:
    return (micros(late) - micros(early)) / F.lit(float(SECOND))


def deadline_clock(calendar: DataFrame, cal: TradingCalendar, at: str = "12:00:00") -> DataFrame:
    """Per day seen as today: open or not, the latest trading day, seconds to its deadline."""
    from tidemark.operators.calendar import previous_trading_day

    now = F.concat_ws(" ", F.col("day").cast("string"), F.lit(at)).cast("timestamp_ntz")
    back = previous_trading_day(calendar)
    latest = F.when(F.col("is_trading_day"), F.col("day")).otherwise(F.col("previous_trading_day"))
    return back.withColumn("latest_day", latest).select(
        "day", "is_trading_day", "latest_day",
        seconds_between(cal.delivery_deadline("latest_day"), now).alias("seconds_to_deadline"))


def eod_late(eod: DataFrame, calendar: DataFrame, cal: TradingCalendar, *, now,
             behind_seconds: float = 86400, overdue_seconds: float = 1800) -> DataFrame:
    """The worst symbol's newest bar against the newest deadline that has a trading day."""
    today = instant(now).cast("date")
    due = calendar.where(F.col("is_trading_day") & (F.col("day") <= today)).agg(
        F.max("day").alias("trading_day"))
    worst = eod.groupBy("symbol").agg(F.max("trade_date").alias("newest")).agg(
        F.min("newest")).scalar()
    out = due.select("trading_day", worst.alias("newest_bar")).withColumn(
        "deadline", cal.delivery_deadline("trading_day"))
    behind = seconds_between(F.col("deadline"), F.col("newest_bar"))
    overdue = seconds_between(instant(now), F.col("deadline"))
    return out.select("trading_day", "newest_bar", behind.alias("behind_seconds"),
                      ((behind > behind_seconds) & (overdue > overdue_seconds)).alias("firing"))


def feed_stalled(cursors: DataFrame, *, now, idle_seconds: float = 600) -> DataFrame:
    """Idle time since the cursor moved, next to the age of its position."""
    at = latest_by(cursors, ["source"], "updated_at")
    idle = F.greatest(seconds_between(instant(now), F.col("updated_at")), F.lit(0.0))
    age = F.greatest(seconds_between(instant(now), F.col("position_ts")), F.lit(0.0))
    return at.select("source", age.alias("position_age_seconds"), idle.alias("idle_seconds"),
                     (idle > idle_seconds).alias("firing"))


def recent(events: DataFrame, *, now, minutes: int) -> DataFrame:
    return events.where((F.col("event_at") > instant(now) - F.expr(f"INTERVAL {minutes} MINUTES"))
                        & (F.col("event_at") <= instant(now)))


def failed_checks(events: DataFrame, *, now, minutes: int = 15) -> DataFrame:
    return recent(events, now=now, minutes=minutes).where("status = 'fail'").groupBy(
        "source", "check_name").agg(F.count(F.lit(1)).alias("failures"))


def sliding_counts(events: DataFrame, keys: Sequence[str], *, hours_us: int = 60 * MINUTE,
                   step_us: int = 5 * MINUTE) -> DataFrame:
    """Events in the trailing window at every step; buckets are counted before they spread."""
    steps = hours_us // step_us
    buckets = events.groupBy(*keys, floor_to(micros("event_at"), step_us).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"))
    spread = buckets.withColumn("_e", F.explode(F.sequence(
        F.col("_b") + F.lit(step_us), F.col("_b") + F.lit(hours_us), F.lit(step_us))))
    return spread.groupBy(*keys, "_e").agg(F.sum("_n").alias("n")).withColumn("_steps", F.lit(steps))


def warn_rate_rising(events: DataFrame, keys: Sequence[str] = ("source", "check_name"), *,
                     threshold: int = 5, hold_minutes: int = 30) -> DataFrame:
    """Runs of evaluations above the threshold that lasted at least the hold time.

    One row per evaluation step (five minutes), so a key's windows are bounded by
    the calendar.
    """
    step = 5 * MINUTE
    high = sliding_counts(events.where("status = 'warn'"), keys).where(F.col("n") > threshold)
    order = Window.partitionBy(*keys).orderBy("_e")
    marked = high.withColumn(
        "_run", F.col("_e") - F.row_number().over(order).cast("bigint") * F.lit(step))
    runs = marked.groupBy(*keys, "_run").agg(
        F.min("_e").alias("a"), F.max("_e").alias("b"), F.max("n").alias("peak"))
    return runs.where(F.col("b") - F.col("a") >= hold_minutes * MINUTE).select(
        *keys, from_micros("a").alias("since"), from_micros("b").alias("until"), "peak")


def below_since(scores: DataFrame, threshold: float) -> DataFrame:
    """Per source now under the threshold: when its current run below it began."""
    ok = scores.groupBy("source").agg(
        F.max(F.when(F.col("score") >= threshold, F.col("computed_at"))).alias("last_ok"))
    low = scores.join(ok, "source").where(
        F.col("last_ok").isNull() | (F.col("computed_at") > F.col("last_ok")))
    return low.groupBy("source").agg(F.min("computed_at").alias("since"),
                                     F.max_by("score", "computed_at").alias("score"))


def vendor_alerts(scores: DataFrame, *, now, warn: float = 0.8, page: float = 0.6,
                  warn_minutes: int = 60, page_minutes: int = 15) -> DataFrame:
    def fired(threshold: float, minutes: int, severity: str) -> DataFrame:
        held = seconds_between(instant(now), F.col("since"))
        return below_since(scores, threshold).where(held >= minutes * 60).select(
            "source", F.lit(severity).alias("severity"), "since", "score")

    return fired(warn, warn_minutes, "warn").unionByName(fired(page, page_minutes, "page"))


#: Name of the alert that each kind of finding raises (fixed values).
NOTHING_CAME, PART_CAME, LOW_SCORE = "DeliveryMissing", "DeliveryIncomplete", "SourceDegraded"


def alert_rows(found: DataFrame, source: Column, severity: str, name: Column,
               incident: Column) -> DataFrame:
    """Findings as alerts; those of one source, name and incident belong together."""
    return found.select(source.alias("source"), F.lit(severity).alias("severity"),
                        name.alias("alert"), incident.cast("string").alias("incident"))


def gap_alerts(gaps: DataFrame, source: str) -> DataFrame:
    """One page per incomplete or empty day; the two kinds are named apart."""
    name = F.when(F.col("kind") == "nothing", NOTHING_CAME).otherwise(PART_CAME)
    return alert_rows(gaps, F.lit(source), "page", name, F.col("day"))


def score_alerts(degraded: DataFrame) -> DataFrame:
    return alert_rows(degraded, F.col("source"), "warn", F.lit(LOW_SCORE), F.col("as_of"))


# ---- figures -------------------------------------------------------------------
def check_outcomes(events: DataFrame) -> DataFrame:
    return events.groupBy("source", "check_name", "status").agg(F.count(F.lit(1)).alias("n"))


def outcome_pivot(events: DataFrame) -> DataFrame:
    """Pass, warn and fail counts per check, zero filled, busiest first."""
    wide = events.groupBy("check_name").pivot("status", ["pass", "warn", "fail"]).count()
    filled = wide.na.fill(0, ["pass", "warn", "fail"])
    return filled.withColumn("total", F.col("pass") + F.col("warn") + F.col("fail")).orderBy(
        F.desc("total"), "check_name")


def statuses_over_time(events: DataFrame, minutes: int = 15) -> DataFrame:
    return events.groupBy(
        floor_to(micros("event_at"), minutes * MINUTE).alias("_b"), "status").agg(
        F.count(F.lit(1)).alias("n")).select(from_micros("_b").alias("bucket"), "status", "n")


def dashboard(events: DataFrame, trades: DataFrame, cursors: DataFrame, *, now) -> DataFrame:
    """Single-number panels as (panel, value) rows."""
    fails = recent(events, now=now, minutes=1440).agg(
        F.count_if(F.col("status") == "fail").cast("double").alias("value"))
    rows = trades.agg(F.count(F.lit(1)).cast("double").alias("value"))
    idle = feed_stalled(cursors, now=now).agg(F.max("idle_seconds").alias("value"))
    return (
        fails.select(F.lit("fails_24h").alias("panel"), "value")
        .unionByName(rows.select(F.lit("rows_trades").alias("panel"), "value"))
        .unionByName(idle.select(F.lit("worst_idle_seconds").alias("panel"), "value")))


def rows_and_age(table: DataFrame, dataset: str, time: str, *, now) -> DataFrame:
    stats = table.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"),
                                        F.max(time).alias("latest"))
    age = F.greatest(seconds_between(instant(now), F.col("latest")), F.lit(0.0))
    return stats.select(F.lit(dataset).alias("dataset"), "symbol", "rows",
                        F.round(age, 1).alias("age_seconds"))


def newest_rows(log: DataFrame, n: int = 20, by: Sequence[str] = ("event_at",)) -> DataFrame:
    """The newest rows; of one time those of the greatest remaining columns, so that reruns agree."""
    rest = [c for c, kind in log.dtypes if c not in by and not kind.startswith("map")]
    return log.orderBy(*[F.desc(c) for c in (*by, *rest)]).limit(int(n))
