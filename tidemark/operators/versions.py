"""Belief-versioned reference data: validity reads and the refresh that never overwrites."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.session import small, versions_in_order

#: Open end of a validity interval (fixed value).
OPEN_END = "2999-12-31"


def _day(value):
    return F.lit(str(value)[:10]).cast("date")


def known_on(table: DataFrame, day) -> DataFrame:
    """Versions believed on a day; both ends inclusive."""
    return table.where((F.col("known_from") <= _day(day)) & (F.col("known_to") >= _day(day)))


def newest_version(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in table.columns if c not in keys]
    order = versions_in_order(table, "known_from")
    return table.groupBy(*keys).agg(*[
        (F.max(c) if c == "known_from" else F.max_by(c, order)).alias(c) for c in rest])


def valid_as_of(facts: DataFrame, versions: DataFrame, keys: Sequence[str], day: str,
                columns: Sequence[str]) -> DataFrame:
    """Each fact with the newest version covering its day, null where none does.

    Versions are folded to one row per key (at most one belief per day each), so the
    facts are neither multiplied nor grouped again.
    """
    folded = versions.groupBy(*keys).agg(F.sort_array(F.collect_list(
        F.struct("known_from", "known_to", *columns))).alias("_versions"))
    covering = F.filter("_versions", lambda v: (v["known_from"] <= F.col(day))
                        & (v["known_to"] >= F.col(day)))
    joined = facts.join(small(folded), list(keys), "left").withColumn(
        "_hit", F.try_element_at(covering, F.lit(-1)))
    return joined.select(*facts.columns, *[F.col(f"_hit.{c}").alias(c) for c in columns])


def notional(facts: DataFrame, specs: DataFrame, *, day: str = "trade_date",
             price: str = "price", lots: str = "lots", on_missing: str = "error") -> DataFrame:
    """Price times lot size of the day times lots; a fact without a spec raises."""
    keyed = valid_as_of(facts, specs, ["exchange", "symbol"], day, ["lot_size"])
    value = F.col(price) * F.col("lot_size") * F.col(lots)
    if on_missing == "error":
        value = F.when(F.col("lot_size").isNull(), F.raise_error(F.concat(
            F.lit("lot size unknown: "), F.col("exchange"), F.lit(":"),
            F.col("symbol"), F.lit(" on "), F.col(day).cast("string")))).otherwise(value)
    return keyed.withColumn("notional", value)


MAP_KEY = ["exchange", "symbol", "trade_date"]


def compare_map(chosen: DataFrame, current: DataFrame) -> DataFrame:
    """Today's choice against the open belief: ``new``, ``changed`` or ``unchanged``."""
    believed = current.where(F.col("known_to") >= _day(OPEN_END)).select(
        *MAP_KEY, F.col("expiry").alias("expiry_known"))
    known = F.col("expiry_known")
    state = F.when(known.isNull(), "new").when(
        ~known.eqNullSafe(F.col("expiry")), "changed").otherwise("unchanged")
    return chosen.select(*MAP_KEY, "expiry").join(believed, MAP_KEY, "left").withColumn(
        "state", state)


def superseded(current: DataFrame, diff: DataFrame) -> DataFrame:
    """Open rows whose belief changed."""
    return current.where(F.col("known_to") >= _day(OPEN_END)).join(
        diff.where("state = 'changed'").select(*MAP_KEY), MAP_KEY, "left_semi")


def refresh_map(chosen: DataFrame, current: DataFrame, *, today) -> DataFrame:
    """The whole map after a refresh: kept rows, closed rows and newly opened rows.

    A changed day closes yesterday and opens today. Two restatements on one day
    leave an empty interval behind, which no read ever matches.
    """
    diff = compare_map(chosen, current)
    keys_changed = diff.where("state = 'changed'").select(*MAP_KEY, F.lit(True).alias("_changed"))
    closing = F.col("_changed").isNotNull() & (F.col("known_to") >= _day(OPEN_END))
    stored = current.join(keys_changed, MAP_KEY, "left").withColumn(
        "known_to", F.when(closing, F.date_sub(_day(today), 1)).otherwise(F.col("known_to"))
    ).select(*current.columns)
    opened = diff.where("state <> 'unchanged'").select(
        "exchange", "symbol", "expiry", "trade_date",
        F.lit(None).cast("date").alias("first_trade"), F.col("expiry").alias("last_trade"),
        F.lit(True).alias("is_front"), _day(today).alias("known_from"),
        _day(OPEN_END).alias("known_to"))
    return stored.unionByName(opened.select(*current.columns))


def refresh_counts(chosen: DataFrame, current: DataFrame) -> DataFrame:
    return compare_map(chosen, current).agg(
        F.count_if(F.col("state") != "unchanged").alias("opened"),
        F.count_if(F.col("state") == "changed").alias("closed"),
        F.count_if(F.col("state") == "unchanged").alias("unchanged"))


def first_map(chosen: DataFrame, *, today) -> DataFrame:
    """The map as a first refresh leaves it."""
    return chosen.select(
        "exchange", "symbol", "expiry", "trade_date",
        F.lit(None).cast("date").alias("first_trade"), F.col("expiry").alias("last_trade"),
        F.lit(True).alias("is_front"), _day(today).alias("known_from"),
        _day(OPEN_END).alias("known_to"))


def spec_rows(spark, raw: dict) -> DataFrame:
    """Specifications from ``{exchange: {symbol: [versions]}}``."""
    rows = [(ex, sym, float(v["lot_size"]), float(v["tick_size"]), v.get("price_unit", ""),
             v.get("quantity_unit", ""), str(v["known_from"])[:10], str(v["known_to"])[:10])
            for ex, symbols in raw.items() for sym, versions in (symbols or {}).items()
            for v in versions]
    df = spark.createDataFrame(rows, "exchange string, symbol string, lot_size double, "
                               "tick_size double, price_unit string, quantity_unit string, "
                               "known_from string, known_to string")
    return df.withColumns({c: F.col(c).cast("date") for c in ("known_from", "known_to")})
