"""Stored reference data: the roll map with its beliefs, and contract specifications.

Both are keyed tables under a manifest, so a refresh that fails leaves the map of the day before,
and a run that is repeated changes nothing. Only the years of the map in which a belief changed are
written anew.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import versions as V
from tidemark.session import discard, written
from tidemark.sources import snapshots

MAP, SPECS = "contract_reference", "contract_specs"


def stored_map(spark: SparkSession, root: str) -> DataFrame:
    return snapshots.read(spark, f"{root}/{MAP}").drop("trade_year")


def refresh(spark: SparkSession, root: str, chosen: DataFrame, *, today, run_id: str) -> dict:
    """Bring the stored map up to today's choice; how many days were opened, closed and unchanged.

    Two refreshes on one day leave an empty interval behind for what the second replaced.
    """
    path = f"{root}/{MAP}"
    before = snapshots.manifest(spark, path)
    if before and run_id in before["runs"]:
        return {"opened": 0, "closed": 0, "unchanged": 0}
    year = F.year("trade_date").alias("trade_year")
    picked = written(chosen.select(*V.MAP_KEY, "expiry"), "chosen")
    if before is None:
        rows = V.first_map(picked, today=today)
        counts = {"opened": picked.count(), "closed": 0, "unchanged": 0}
        years = None
    else:
        current = snapshots.read(spark, path)
        diff = written(V.compare_map(picked, current), "compared")
        counts = {"opened": 0, "closed": 0, "unchanged": 0}
        for r in diff.groupBy("state").count().collect():
            counts["unchanged" if r["state"] == "unchanged" else "opened"] += r["count"]
            counts["closed"] += r["count"] * (r["state"] == "changed")
        touched = diff.where("state <> 'unchanged'").select(year).distinct()
        years = [str(r[0]) for r in touched.collect()]       # as many as the map has years
        held = current.where(F.col("trade_year").isin([int(y) for y in years])).drop("trade_year")
        rows = V.refresh_map(picked.where(F.year("trade_date").isin([int(y) for y in years])), held, today=today)
        discard(diff)
    if years is None or years:
        snapshots.replace(spark, path, rows.select("*", year), [*V.MAP_KEY, "known_from"], "trade_year", run_id,
                          parts=years)
    discard(picked)
    return counts


def stored_specs(spark: SparkSession, root: str) -> DataFrame:
    return snapshots.read(spark, f"{root}/{SPECS}").drop("from_year")


def load_specs(spark: SparkSession, root: str, raw: dict, *, run_id: str) -> None:
    """All specifications anew from ``{exchange: {symbol: [versions]}}``."""
    rows = V.spec_rows(spark, raw).withColumn("from_year", F.year("known_from"))
    snapshots.replace(spark, f"{root}/{SPECS}", rows, ["exchange", "symbol", "known_from"], "from_year", run_id)
