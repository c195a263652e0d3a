"""Trading calendar as columns and small frames.

A calendar has one row per day, so broadcasting it is bounded by its date range.
"""
from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.times import as_col, instant

WEEKDAYS = {"mon": 0, "tue": 1, "wed": 2, "thu": 3, "fri": 4, "sat": 5, "sun": 6}


@dataclass(frozen=True)
class TradingCalendar:
    name: str = "default"
    timezone: str = "UTC"
    trading_days: tuple[str, ...] = ("mon", "tue", "wed", "thu", "fri")
    deadline: str = "23:55"
    grace_minutes: int = 30
    session_open: str = "09:00"
    session_close: str = "23:30"
    holidays: dict = field(default_factory=dict)   # ISO date -> name

    @classmethod
    def from_dict(cls, raw: dict) -> TradingCalendar:
        closed = {str(h["date"])[:10]: h.get("name", "holiday")
                  for key, entries in raw.items() if key.startswith("holidays")
                  for h in entries or []}
        published, session = raw.get("publication", {}), raw.get("session", {})
        return cls(raw.get("name", "default"), raw.get("timezone", "UTC"),
                   tuple(raw.get("trading_days", ())), published.get("deadline", "23:55"),
                   int(published.get("grace_minutes", 30)), session.get("open", "09:00"),
                   session.get("close", "23:30"), closed)

    @classmethod
    def from_json(cls, text: str) -> TradingCalendar:
        return cls.from_dict(json.loads(text))

    def holiday_frame(self, spark: SparkSession) -> DataFrame:
        rows = sorted(self.holidays.items())
        return spark.createDataFrame(rows, "day string, holiday string").select(
            F.col("day").cast("date").alias("day"), "holiday")

    # ---- columns of a day -------------------------------------------------
    def open_weekday(self, day) -> Column:
        return F.weekday(as_col(day)).isin([WEEKDAYS[d] for d in self.trading_days])

    def _at(self, day, clock: str) -> Column:
        """A wall-clock time on that day in the exchange zone, as UTC."""
        local = F.concat_ws(" ", as_col(day).cast("string"), F.lit(f"{clock}:00")).cast("timestamp")
        return F.to_utc_timestamp(local, self.timezone).cast("timestamp_ntz")

    def delivery_deadline(self, day) -> Column:
        return self._at(day, self.deadline)

    def cutoff(self, day) -> Column:
        return self.delivery_deadline(day) + F.expr(f"INTERVAL {self.grace_minutes} MINUTES")

    def is_overdue(self, day, now) -> Column:
        return instant(now) > self.cutoff(day)

    def session_start(self, day) -> Column:
        return self._at(day, self.session_open)

    def session_end(self, day) -> Column:
        """A close at or before the open belongs to the next calendar day."""
        rolls = self.session_close <= self.session_open
        return self._at(F.date_add(as_col(day), 1) if rolls else day, self.session_close)

    def local_day(self, ts) -> Column:
        return F.to_date(F.from_utc_timestamp(as_col(ts).cast("timestamp"), self.timezone))


def day_spine(df: DataFrame, column: str, before: int = 0, after: int = 0) -> DataFrame:
    """Every calendar day between the first and last date of a column."""
    day = F.col(column).cast("date")
    return df.agg(F.min(day).alias("a"), F.max(day).alias("b")).select(
        F.explode(F.sequence(F.date_sub("a", before), F.date_add("b", after))).alias("day"))


def classify(days: DataFrame, cal: TradingCalendar, holidays: DataFrame) -> DataFrame:
    """``day`` with ``is_trading_day`` and a plain-language ``why_closed``."""
    joined = days.join(holidays, "day", "left")
    why = F.when(~cal.open_weekday("day"), "weekend").when(
        F.col("holiday").isNotNull(), F.concat(F.lit("holiday: "), F.col("holiday")))
    return joined.select(*[c for c in days.columns], why.alias("why_closed"),
                         why.isNull().alias("is_trading_day"))


def trading_days(days: DataFrame, cal: TradingCalendar, holidays: DataFrame) -> DataFrame:
    return classify(days, cal, holidays).where("is_trading_day").select("day")


def previous_trading_day(calendar: DataFrame) -> DataFrame:
    """Last trading day strictly before each day of a classified spine."""
    # One row per calendar day: a single ordered pass over the spine.
    back = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return calendar.withColumn(
        "previous_trading_day",
        F.max(F.when(F.col("is_trading_day"), F.col("day"))).over(back))


def expected_days(spark: SparkSession, cal: TradingCalendar, holidays: DataFrame, *, now,
                  lookback: int = 7) -> DataFrame:
    """Recent trading days whose delivery is already overdue at ``now``."""
    through = instant(now).cast("date")
    days = spark.range(1).select(
        F.explode(F.sequence(F.date_sub(through, lookback), through)).alias("day"))
    return trading_days(days, cal, holidays).where(cal.is_overdue("day", now))


def sessions(calendar: DataFrame, cal: TradingCalendar) -> DataFrame:
    """Session bounds of each day, null when shut."""
    is_open = F.col("is_trading_day")
    return calendar.select(
        "day", F.when(is_open, cal.session_start("day")).alias("session_open"),
        F.when(is_open, cal.session_end("day")).alias("session_close"))


def with_session(events: DataFrame, calendar: DataFrame, cal: TradingCalendar,
                 time: str = "ts") -> DataFrame:
    """Adds ``session_date``: the session an event falls in, null outside every session.

    Only the local day and the day before can contain it, so two equi joins on a
    day replace a range join.
    """
    bounds = sessions(calendar, cal).where(F.col("session_open").isNotNull())
    today = bounds.select(F.col("day").alias("_d0"), F.col("session_open").alias("_o0"),
                          F.col("session_close").alias("_c0"))
    eve = bounds.select(F.col("day").alias("_d1"), F.col("session_open").alias("_o1"),
                        F.col("session_close").alias("_c1"))
    local = cal.local_day(time)
    at = F.col(time)
    return (
        events.withColumn("_local", local)
        .join(today, F.col("_local") == F.col("_d0"), "left")
        .join(eve, F.date_sub("_local", 1) == F.col("_d1"), "left")
        .withColumn("session_date",
                    F.when((at >= F.col("_o0")) & (at < F.col("_c0")), F.col("_d0"))
                    .when((at >= F.col("_o1")) & (at < F.col("_c1")), F.col("_d1")))
        .drop("_local", "_d0", "_o0", "_c0", "_d1", "_o1", "_c1")
    )
