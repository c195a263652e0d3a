"""Front contract, roll map and back-adjusted continuous series, all symbols at once.

Windows here run per (exchange, symbol) over contract days. Their size is bounded by
the calendar (about 250 days a year), not by trading activity.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

GROUP = ["exchange", "symbol"]
DAY = [*GROUP, "trade_date"]


def forbid_rolling_back(chosen: DataFrame) -> DataFrame:
    """The front expiry never decreases in time."""
    upto = (
        Window.partitionBy(*GROUP).orderBy("trade_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return chosen.withColumn("expiry", F.max("expiry").over(upto))


def front_by_volume(eod: DataFrame) -> DataFrame:
    """Most traded unexpired contract of each day; a tie goes to the earliest expiry."""
    live = eod.where(F.col("expiry") >= F.col("trade_date"))
    order = F.struct(F.col("volume"), -F.unix_date("expiry"))
    return live.groupBy(*DAY).agg(F.max_by("expiry", order).alias("expiry"))


def front_by_expiry(eod: DataFrame, buffer_days: int = 3) -> DataFrame:
    """Nearest expiry at least ``buffer_days`` away."""
    far = eod.where(F.col("expiry") >= F.date_add("trade_date", buffer_days))
    return far.groupBy(*DAY).agg(F.min("expiry").alias("expiry"))


def front_month_map(eod: DataFrame, method: str = "volume", buffer_days: int = 3) -> DataFrame:
    if method == "volume":
        chosen = front_by_volume(eod)
    elif method == "nearest":
        chosen = front_by_expiry(eod, buffer_days)
    else:
        raise ValueError(f"unknown front-month method {method!r}")
    return forbid_rolling_back(chosen).withColumns(
        {"known_from": F.col("trade_date"), "is_front": F.lit(True)})


def front_prices(eod: DataFrame, chosen: DataFrame, price: str = "close") -> DataFrame:
    """Price of the front contract on each day it printed; other days are absent."""
    return chosen.select(*DAY, "expiry").join(eod, [*DAY, "expiry"], "left").where(
        F.col(price).isNotNull())


def flag_rolls(series: DataFrame) -> DataFrame:
    """First printed day of a new front contract, with the contract it replaced."""
    by_day = Window.partitionBy(*GROUP).orderBy("trade_date")
    out = series.withColumn("prev_expiry", F.lag("expiry").over(by_day))
    return out.withColumn("is_roll", F.coalesce(
        F.col("expiry") != F.col("prev_expiry"), F.lit(False)))


def splice_pairs(eod: DataFrame, rolls: DataFrame, price: str = "close") -> DataFrame:
    """Per roll: both closes on the last day on or before it on which both contracts printed.

    An expiry is left at most once and entered at most once, so both joins are
    one roll to one contract's rows.
    """
    prices = eod.where(F.col(price).isNotNull()).select(
        *GROUP, F.col("trade_date").alias("d"), "expiry", F.col(price).alias("p"))
    leaving = prices.where("p <> 0").select(
        *GROUP, "d", F.col("expiry").alias("prev_expiry"), F.col("p").alias("old_price"))
    entering = prices.select(*GROUP, "d", "expiry", F.col("p").alias("new_price"))
    keys = [*GROUP, "expiry", "prev_expiry"]
    both = (
        rolls.select(*keys, F.col("trade_date").alias("roll_date"))
        .join(leaving, [*GROUP, "prev_expiry"])
        .where(F.col("d") <= F.col("roll_date"))
        .join(entering, [*GROUP, "expiry", "d"])
    )
    return both.groupBy(*keys, "roll_date").agg(
        F.max_by("old_price", "d").alias("old_price"),
        F.max_by("new_price", "d").alias("new_price"), F.max("d").alias("splice_date"))


def _later() -> Window:
    # Newest first, so that each row adds to one running value.
    return Window.partitionBy(*GROUP).orderBy(F.desc("trade_date")).rowsBetween(
        Window.unboundedPreceding, -1)


def ratio_factor(ratio: Column) -> Column:
    """Product of the ratios of all later rolls; the newest segment keeps its prices."""
    return F.coalesce(F.product(ratio).over(_later()), F.lit(1.0))


def difference_offset(gap: Column) -> Column:
    return F.coalesce(F.sum(gap).over(_later()), F.lit(0.0))


def newest_belief(roll_map: DataFrame) -> DataFrame:
    """One expiry per day from a versioned map, the latest belief winning."""
    return roll_map.groupBy(*DAY).agg(F.max_by("expiry", "known_from").alias("expiry"))


def continuous_series(eod: DataFrame, *, method: str = "volume", adjust: str = "ratio",
                      as_of=None, known_at=None, price: str = "close",
                      roll_map: DataFrame | None = None) -> DataFrame:
    """Back-adjusted front-month series per symbol.

    ``as_of`` truncates by trade date, ``known_at`` by ingest time. ``roll_map`` is a
    stored map to use instead of applying the rule. ``roll_adjusted`` is set on roll
    rows only: False where no shared day exists and a jump remains.
    """
    if adjust not in ("ratio", "difference", "none"):
        raise ValueError(f"unknown adjustment {adjust!r}")
    rows = eod
    if known_at is not None:
        rows = rows.where(F.col("ingested_at") <= F.lit(str(known_at)).cast("timestamp_ntz"))
    if as_of is not None:
        rows = rows.where(F.col("trade_date") <= F.lit(str(as_of)[:10]).cast("date"))
    if roll_map is None:
        chosen = front_month_map(rows, method)
    else:
        stored = roll_map
        if as_of is not None:
            stored = stored.where(F.col("trade_date") <= F.lit(str(as_of)[:10]).cast("date"))
        chosen = forbid_rolling_back(newest_belief(stored))
    series = flag_rolls(front_prices(rows, chosen, price))
    if adjust == "none":
        out = series.withColumn("roll_adjusted", F.lit(None).cast("boolean")).withColumn(
            "adj_close", F.col(price))
    else:
        pairs = splice_pairs(rows, series.where("is_roll"), price)
        spliced = series.join(
            pairs.withColumnRenamed("roll_date", "trade_date").select(
                *DAY, "old_price", "new_price"), DAY, "left")
        if adjust == "ratio":
            adjusted = F.col(price) * ratio_factor(F.col("new_price") / F.col("old_price"))
        else:
            adjusted = F.col(price) + difference_offset(F.col("new_price") - F.col("old_price"))
        out = spliced.withColumn("roll_adjusted", F.when(
            F.col("is_roll"), F.col("old_price").isNotNull())).withColumn("adj_close", adjusted)
    wanted = ["exchange", "trade_date", "symbol", "expiry", "is_roll", "roll_adjusted", price,
              "adj_close", "volume", "open_interest"]
    return out.select(*[c for c in wanted if c in out.columns])


def worst_jump(series: DataFrame, price: str = "close") -> DataFrame:
    """Largest absolute return on a roll day, per symbol."""
    by_day = Window.partitionBy(*GROUP).orderBy("trade_date")
    jumps = series.withColumn(
        "jump", F.try_divide(F.col(price), F.lag(price).over(by_day)) - 1).where(
        F.col("is_roll") & F.col("jump").isNotNull())
    return jumps.groupBy(*GROUP).agg(
        F.max_by("trade_date", F.struct(F.abs("jump"), F.col("trade_date"))).alias("trade_date"),
        F.max(F.abs("jump")).alias("size"), F.count(F.lit(1)).alias("rolls"))


def tail_days(series: DataFrame, n: int = 120) -> DataFrame:
    newest = Window.partitionBy(*GROUP).orderBy(F.desc("trade_date"))
    return series.withColumn("_rn", F.row_number().over(newest)).where(
        F.col("_rn") <= n).drop("_rn")


def returns_compared(series: DataFrame, price: str = "close") -> DataFrame:
    """Raw and adjusted daily returns side by side, and what the roll put into the raw one."""
    by_day = Window.partitionBy(*GROUP).orderBy("trade_date")

    def ret(c: str) -> Column:
        return F.try_divide(F.col(c), F.lag(c).over(by_day)) - 1

    return series.select(
        *DAY, "is_roll", ret(price).alias("raw_ret"), ret("adj_close").alias("adj_ret"),
    ).withColumn("artefact", F.col("raw_ret") - F.col("adj_ret"))


def fingerprint(series: DataFrame, column: str = "adj_close", decimals: int = 6) -> DataFrame:
    """Rows, date range and a digest per symbol (one row per day).

    A month's digest is the SHA-256 of its lines ``day:value`` in order of days, the value scaled to
    a whole number; the series' digest is that of the digests of its months, a line each. No
    series is gathered in one place.
    """
    value = F.coalesce(F.round(F.col(column) * 10 ** decimals).cast("bigint").cast("string"), F.lit("null"))
    lines = series.select(*GROUP, "trade_date", F.date_trunc("month", "trade_date").alias("_month"), F.concat_ws(
        ":", F.col("trade_date").cast("string"), value).alias("_line"))

    def digest(order: str, text: str):
        rows = F.sort_array(F.collect_list(F.struct(order, text)))
        return F.sha2(F.concat_ws("\n", F.transform(rows, lambda r: r[text])), 256)

    months = lines.groupBy(*GROUP, "_month").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("trade_date").alias("_first"), F.max("trade_date").alias("_last"),
        digest("trade_date", "_line").alias("_digest"))
    return months.groupBy(*GROUP).agg(
        F.sum("_rows").alias("rows"), F.min("_first").alias("first_date"), F.max("_last").alias("last_date"),
        digest("_month", "_digest").alias("series_sha"))
