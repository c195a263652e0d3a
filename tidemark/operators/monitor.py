"""What should be here and is not: arrivals against the calendar, backfill plans."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.times import SECOND, from_micros, instant, micros
from tidemark.operators.calendar import TradingCalendar


def arrivals_per_day(table: DataFrame, day: str = "trade_date",
                     symbol: str | None = "symbol") -> DataFrame:
    """Rows per (day, symbol), or per day with a null symbol when no list is declared."""
    name = F.col(symbol) if symbol else F.lit(None).cast("string")
    return table.groupBy(F.col(day).cast("date").alias("day"), name.alias("symbol")).agg(
        F.count(F.lit(1)).alias("rows"))


def expected_pairs(days: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Every due day with every configured symbol; the list comes from configuration."""
    return days.select("day", F.explode(F.array(*[F.lit(s) for s in symbols])).alias("symbol"))


def missing_arrivals(days: DataFrame, arrivals: DataFrame, symbols: Sequence[str]) -> DataFrame:
    return expected_pairs(days, symbols).join(arrivals, ["day", "symbol"], "left_anti")


def gaps(days: DataFrame, table: DataFrame, cal: TradingCalendar,
         symbols: Sequence[str] = (), day: str = "trade_date",
         symbol: str = "symbol") -> DataFrame:
    """One row per due day that is empty or incomplete, naming what is missing."""
    arrivals = arrivals_per_day(table, day, symbol if symbols else None)
    found = arrivals.groupBy("day").agg(F.sum("rows").alias("rows_found"))
    out = days.join(found, "day", "left").withColumn(
        "rows_found", F.coalesce("rows_found", F.lit(0)))
    if symbols:
        # At most one entry per configured symbol.
        missing = missing_arrivals(days, arrivals, symbols).groupBy("day").agg(
            F.sort_array(F.collect_list("symbol")).alias("missing_symbols"))
        out = out.join(missing, "day", "left")
    else:
        out = out.withColumn("missing_symbols", F.lit(None).cast("array<string>"))
    return (
        out.where((F.col("rows_found") == 0) | F.col("missing_symbols").isNotNull())
        .withColumn("kind", F.when(F.col("rows_found") == 0, "nothing").otherwise("partial"))
        .withColumn("deadline", cal.delivery_deadline("day"))
    )


def arrival_status(calendar: DataFrame, first_seen: DataFrame, cal: TradingCalendar, *,
                   poll_seconds: int = 900, max_wait_minutes: int = 120) -> DataFrame:
    """Score each day's delivery as polling from its deadline would have.

    ``first_seen`` has ``day`` and ``available_at``. A file is noticed at the first
    poll not before it exists; the last poll is the first one at or past the close.
    """
    step = poll_seconds * SECOND
    last = -(-max_wait_minutes * 60 // poll_seconds)
    due = micros(cal.delivery_deadline("day"))
    # greatest() skips nulls, so a day without a file has to stay null explicitly.
    polls = F.when(F.col("available_at").isNotNull(), F.ceil(
        F.greatest(micros("available_at") - due, F.lit(0)) / F.lit(step)))
    joined = calendar.join(first_seen, "day", "left").withColumns({"_due": due, "_polls": polls})
    found = F.coalesce(F.col("_polls") <= last, F.lit(False))
    seen = F.col("_due") + F.col("_polls") * F.lit(step)
    grace = cal.grace_minutes * 60 * SECOND
    status = (
        F.when(~F.col("is_trading_day"), "skipped").when(~found, "missing")
        .when(seen <= F.col("_due") + grace, "on_time").otherwise("late"))
    hit = F.col("status").isin("on_time", "late")
    return joined.withColumn("status", status).select(
        "day", "status", from_micros("_due").alias("deadline"),
        F.when(F.col("status") == "skipped", 0).when(hit, F.col("_polls") + 1)
        .otherwise(last + 1).cast("bigint").alias("attempts"),
        F.when(hit, from_micros(seen)).alias("arrived_at"),
        F.when(hit, F.greatest(seen - F.col("_due"), F.lit(0)) / F.lit(float(SECOND)))
        .otherwise(0.0).alias("delay_seconds"))


#: Arrival status to quality status (fixed values).
TIMELINESS = {"on_time": "pass", "late": "warn", "missing": "fail", "skipped": "pass"}


def timeliness_events(arrivals: DataFrame) -> DataFrame:
    status = F.col("status")
    grade = F.lit(None).cast("string")
    for name, value in TIMELINESS.items():
        grade = F.when(status == name, value).otherwise(grade)
    return arrivals.select("day", F.lit("publication_timeliness").alias("check_name"),
                           grade.alias("status"))


def backfill_plan(calendar: DataFrame, loaded: DataFrame, newest=None,
                  symbols: Sequence[str] | None = None) -> DataFrame:
    """Trading days not loaded yet; closed days never appear. With ``symbols``, one row for each
    day and symbol that is missing."""
    days = calendar.where("is_trading_day").select("day")
    if newest is not None:
        days = days.where(F.col("day") <= F.lit(str(newest)[:10]).cast("date"))
    if symbols is None:
        return days.join(loaded.select("day").distinct(), "day", "left_anti")
    return expected_pairs(days, symbols).join(loaded.select("day", "symbol").distinct(), ["day", "symbol"], "left_anti")


#: Why a day was skipped (fixed values; logs are read by them).
IN_FUTURE, NOT_YET, NOTHING = "in the future", "not published yet", "nothing published"


def backfill_report(calendar: DataFrame, arrivals: DataFrame, cal: TradingCalendar | None = None,
                    now=None) -> DataFrame:
    """Every day of a range: fetched, or skipped with the reason.

    With a calendar and a clock, a day after today in the exchange's zone is in the future, whatever
    its weekday, and a trading day whose deadline and grace have not passed is not published yet.
    """
    joined = calendar.join(arrivals.groupBy("day").agg(F.sum("rows").alias("rows")), "day", "left")
    why = F.col("why_closed")
    if now is not None:
        early = F.when(~cal.is_overdue("day", now), F.concat(F.lit(f"{NOT_YET}, due "), F.lit(cal.deadline)))
        why = F.when(F.col("day") > cal.local_day(instant(now)), IN_FUTURE).otherwise(F.coalesce(why, early))
    outcome = F.coalesce(why, F.when(F.col("rows").isNull(), NOTHING).otherwise("fetched"))
    return joined.select("day", outcome.alias("outcome"), F.when(why.isNull(), F.col("rows")).alias("rows"))
