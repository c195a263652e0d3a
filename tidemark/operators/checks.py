"""Quality checks as one-row frames, the publish decision and vendor scores.

Each check returns ``check_name, status, measure, detail, rows_in, rows_out`` so that
a report is a union of small aggregates.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.carry import lag_sliced
from tidemark.functions.times import MINUTE, SECOND, floor_to, instant, micros
from tidemark.operators.contract import REASON
from tidemark.session import versions_in_order

FIELDS = ("check_name", "status", "measure", "detail", "rows_in", "rows_out")


def _as_check(name: str, status: Column, measure: Column, detail: Column, rows_in: Column,
              rows_out: Column) -> list[Column]:
    return [F.lit(name).alias("check_name"), status.alias("status"),
            measure.cast("double").alias("measure"), detail.alias("detail"),
            rows_in.cast("bigint").alias("rows_in"), rows_out.cast("bigint").alias("rows_out")]


def _warn(bad: Column) -> Column:
    return F.when(bad, "warn").otherwise("pass")


def _fail(bad: Column) -> Column:
    return F.when(bad, "fail").otherwise("pass")


def top_reasons(rejected: DataFrame, n: int = 3) -> DataFrame:
    return rejected.groupBy(F.col(REASON).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "reason").limit(n)


def check_contract(verdict: DataFrame) -> DataFrame:
    """Blocked by shape or by a budget: fail. Some rows quarantined: warn."""
    status = F.when(F.col("blocking"), "fail").when(F.col("rejected") > 0, "warn").otherwise("pass")
    return verdict.select(*_as_check(
        "contract", status, F.col("rejected"),
        F.format_string("%d of %d rows quarantined", "rejected", "rows"),
        F.col("rows_in"), F.col("clean")))


def check_uniqueness(verdict: DataFrame) -> DataFrame:
    return verdict.select(*_as_check(
        "uniqueness", _warn(F.col("duplicates") > 0), F.col("duplicates"),
        F.format_string("%d duplicate rows", "duplicates"), F.col("rows_in"), F.col("clean")))


def out_of_order_ids(clean: DataFrame, key: str = "symbol", time: str = "ts",
                     ident: str = "trade_id") -> DataFrame:
    """Per key: steps in time at which the id went down.

    Ids inside one instant are unordered, so an instant is reduced to its lowest and
    highest id first; that also keeps a hot instant from becoming a hot task.
    """
    instants = clean.groupBy(key, micros(time).alias("_us")).agg(
        F.min(ident).alias("_lo"), F.max(ident).alias("_hi"))
    return lag_sliced(instants, [key], "_us", ["_hi"]).groupBy(key).agg(
        F.count_if(F.col("_lo") < F.col("prev__hi")).alias("out_of_order"))


def check_monotonic_id(clean: DataFrame, key: str = "symbol") -> DataFrame:
    total = out_of_order_ids(clean, key).agg(
        F.coalesce(F.sum("out_of_order"), F.lit(0)).alias("n"))
    rows = clean.agg(F.count(F.lit(1))).scalar()
    return total.select(*_as_check(
        "monotonic_trade_id", _warn(F.col("n") > 0), F.col("n"),
        F.format_string("%d out-of-order ids", "n"), rows, rows))


def minute_gaps(clean: DataFrame, time: str = "ts") -> DataFrame:
    """Minutes of the span, minutes with prints, minutes without."""
    minutes = clean.groupBy(floor_to(micros(time), MINUTE).alias("m")).agg(
        F.count(F.lit(1)).alias("n"))
    return minutes.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("with_prints"),
        (((F.max("m") - F.min("m")) / MINUTE).cast("bigint") + 1).alias("span"),
    ).withColumn("missing", F.greatest(F.col("span") - F.col("with_prints"), F.lit(0)))


def check_gaps(clean: DataFrame, time: str = "ts") -> DataFrame:
    return minute_gaps(clean, time).where("rows > 0").select(*_as_check(
        "gap_scan", _warn(F.col("missing") > 0), F.col("missing"),
        F.format_string("%d of %d minutes with no prints", "missing", "span"),
        F.col("rows"), F.col("rows")))


def check_freshness(clean: DataFrame, time: str, *, now, sla_seconds: float = 86400,
                    mode: str = "live") -> DataFrame:
    """Age of the newest event against a wall-clock bound; not asked of a backfill."""
    latest = clean.agg(F.max(time).alias("latest"), F.count(F.lit(1)).alias("n"))
    if mode == "backfill":
        return latest.select(*_as_check(
            "freshness", F.lit("pass"), F.lit(0.0), F.lit("not asked of a backfill"),
            F.col("n"), F.col("n")))
    age = F.greatest((micros(instant(now)) - micros("latest")) / F.lit(float(SECOND)), F.lit(0.0))
    return latest.where("n > 0").withColumn("age", age).select(*_as_check(
        "freshness", _fail(F.col("age") > float(sla_seconds)), F.col("age"),
        F.format_string("newest event %.1f min old", F.col("age") / 60), F.col("n"), F.col("n")))


def check_freshness_calendar(clean: DataFrame, day: str, expected: DataFrame) -> DataFrame:
    """The newest day must be the newest one already due."""
    due = expected.agg(F.max("day")).scalar()
    latest = clean.agg(F.max(F.col(day).cast("date")).alias("latest"),
                       F.count(F.lit(1)).alias("n")).withColumn("due", due)
    behind = F.col("due").isNotNull() & ~F.coalesce(F.col("latest") >= F.col("due"), F.lit(False))
    return latest.where("n > 0").select(*_as_check(
        "freshness", _fail(behind), F.datediff("due", "latest"),
        F.concat_ws(" ", F.lit("newest day"), F.col("latest").cast("string"),
                    F.lit("newest due"), F.col("due").cast("string")),
        F.col("n"), F.col("n")))


def volume_share(clean: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per symbol: declared volume, loaded volume and the share lost at the gate."""
    both = clean.select("symbol", "volume", F.col("volume").alias("kept")).unionByName(
        rejected.select("symbol", "volume"), allowMissingColumns=True)
    sums = both.groupBy("symbol").agg(F.sum("volume").alias("declared"),
                                      F.coalesce(F.sum("kept"), F.lit(0.0)).alias("loaded"))
    return sums.withColumn("share", F.try_divide(
        F.abs(F.col("loaded") - F.col("declared")), F.col("declared")))


def check_volume(clean: DataFrame, rejected: DataFrame, tolerance_pct: float = 0.0) -> DataFrame:
    rows_in = clean.unionByName(rejected.drop(REASON)).agg(F.count(F.lit(1))).scalar()
    worst = volume_share(clean, rejected).agg(
        F.coalesce(F.max("share") * 100, F.lit(0.0)).alias("worst"))
    return worst.select(*_as_check(
        "volume_accounted", _warn(F.col("worst") > tolerance_pct), F.col("worst"),
        F.format_string("largest share of a symbol's volume quarantined: %.4f%%", "worst"),
        rows_in, clean.agg(F.count(F.lit(1))).scalar()))


def _present(clean: DataFrame, day: str) -> DataFrame:
    return clean.select(F.col(day).cast("date").alias("day"), "symbol").where(
        F.col("day").isNotNull() & F.col("symbol").isNotNull()).distinct()


def missing_days(clean: DataFrame, calendar: DataFrame, day: str = "trade_date") -> DataFrame:
    """Trading days inside the file's span that carry no row; asked only past one day."""
    present = _present(clean, day).select("day").distinct()
    span = present.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    spine = span.where("a < b").select(F.explode(F.sequence("a", "b")).alias("day"))
    open_days = calendar.where("is_trading_day").select("day")
    return spine.join(open_days, "day", "left_semi").join(present, "day", "left_anti")


def short_days(clean: DataFrame, day: str = "trade_date") -> DataFrame:
    """(day, symbol) absent although the file has the symbol on some other day.

    Days are collected per symbol, never symbols per day: the number of days is
    bounded by the calendar.
    """
    present = _present(clean, day)
    every_day = present.agg(F.collect_set("day")).scalar()
    return present.groupBy("symbol").agg(F.collect_set("day").alias("seen")).select(
        F.explode(F.array_except(every_day, "seen")).alias("day"), "symbol")


def missing_symbols(clean: DataFrame, configured: Sequence[str]) -> DataFrame:
    """Configured symbols the file never mentions."""
    wanted = clean.sparkSession.createDataFrame([(s,) for s in configured], "symbol string")
    return wanted.join(clean.select("symbol").distinct(), "symbol", "left_anti")


def check_coverage(clean: DataFrame, calendar: DataFrame | None = None,
                   configured: Sequence[str] = (), day: str = "trade_date") -> DataFrame:
    """Any missing day, short day or absent symbol fails the file."""
    n_short = short_days(clean, day).select("day").distinct().agg(F.count(F.lit(1))).scalar()
    n_days = F.lit(0) if calendar is None else (
        missing_days(clean, calendar, day).agg(F.count(F.lit(1))).scalar())
    n_symbols = missing_symbols(clean, configured).agg(
        F.count(F.lit(1))).scalar() if configured else F.lit(0)
    return clean.agg(F.count(F.lit(1)).alias("n")).select(
        "n", n_days.alias("d"), n_short.alias("s"), n_symbols.alias("y")).select(*_as_check(
            "expected_coverage", _fail(F.col("d") + F.col("s") + F.col("y") > 0),
            F.col("d") + F.col("s") + F.col("y"),
            F.format_string("%d absent days, %d short days, %d absent symbols", "d", "s", "y"),
            F.col("n"), F.col("n")))


def check_min_rows(clean: DataFrame, minimum: int) -> DataFrame:
    return clean.agg(F.count(F.lit(1)).alias("n")).select(*_as_check(
        "expect_rows_min", _fail(F.col("n") < int(minimum)), F.col("n"),
        F.format_string(f"%d rows, at least {int(minimum)} expected", "n"),
        F.col("n"), F.col("n")))


def check_completeness(clean: DataFrame, expected_rows: int) -> DataFrame:
    share = F.col("n") / F.lit(float(expected_rows))
    return clean.agg(F.count(F.lit(1)).alias("n")).select(*_as_check(
        "completeness_vs_expected", _warn(share < 0.999), share,
        F.format_string("%.2f%% of expected rows arrived", share * 100),
        F.lit(expected_rows), F.col("n")))


def schema_version_status(version: str, known: DataFrame | None, dataset: str,
                          accept: bool = False, readable: bool = True) -> tuple[str, str, bool]:
    """(status, detail, record it?) of a contract version against those seen before.

    ``known`` None means the table does not exist yet; ``readable`` False means it
    could not be read, which blocks instead of looking like a first sighting.
    """
    if not readable:
        return "fail", "version history cannot be read, so nothing is published", False
    newest, repeated = None, False
    if known is not None:
        seen = known.where(F.col("dataset") == dataset).agg(
            F.max_by("schema_version", "first_seen").alias("newest"),
            F.coalesce(F.bool_or(F.col("schema_version") == version), F.lit(False))
            .alias("repeated")).first()
        newest, repeated = seen["newest"], seen["repeated"]
    if repeated:
        return "pass", f"version {version}, unchanged", False
    if newest is None:
        return "pass", f"first sighting of version {version}", True
    if accept:
        return "pass", f"version changed {newest} to {version}, accepted", True
    return "fail", f"version changed {newest} to {version} and nobody accepted it", False


#: A retired check name and what it stands for now (fixed values).
ALIASES = {"reconcile_totals": ("volume_accounted", "expected_coverage")}


def expand_checks(wanted: Sequence[str]) -> list[str]:
    out: list[str] = []
    for name in wanted:
        for check in ALIASES.get(name, (name,)):
            if check not in out:
                out.append(check)
    return out


def report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def publishable(results: DataFrame) -> DataFrame:
    """One row: whether no check failed, and which did."""
    return results.agg(
        F.bool_and(F.col("status") != "fail").alias("publishable"),
        F.count_if(F.col("status") == "fail").alias("failed"),
        F.count_if(F.col("status") == "warn").alias("warned"))


def event_rows(results: DataFrame, *, run_id: str, dataset: str, source: str, now) -> DataFrame:
    return results.select(
        F.lit(run_id).alias("run_id"), F.lit(dataset).alias("dataset"),
        F.lit(source).alias("source"), "check_name", "status", "rows_in", "rows_out", "detail",
        instant(now).alias("event_at"))


def declared_matrix(declared: DataFrame, results: DataFrame) -> DataFrame:
    """Declared checks with their outcome, plus checks that ran undeclared."""
    ran = results.select("check_name", "status")
    left = declared.join(ran, "check_name", "left").select(
        "check_name", F.coalesce("status", F.lit("pass")).alias("status"),
        F.col("status").isNotNull().alias("evaluated"), F.lit(True).alias("declared"))
    extra = ran.join(declared, "check_name", "left_anti").select(
        "check_name", "status", F.lit(True).alias("evaluated"), F.lit(False).alias("declared"))
    return left.unionByName(extra)


#: Scoring weights and colour thresholds (fixed values).
WEIGHTS = {"freshness": 0.4, "completeness": 0.4, "accuracy": 0.2}
THRESHOLDS = {"green": 0.95, "amber": 0.85}


def score_columns(clean: Column, rejected: Column, age: Column, target: Column,
                  mode: str = "live") -> dict[str, Column]:
    """Freshness, completeness, accuracy, score and colour of one load."""
    rows_in = F.greatest(clean + rejected, F.lit(1))
    fresh = F.when(clean == 0, 0.0).when(age > target, F.least(F.lit(1.0), target / age)).otherwise(1.0)
    complete, accurate = clean / rows_in, 1.0 - rejected / rows_in
    if mode == "backfill":
        weight = WEIGHTS["completeness"] + WEIGHTS["accuracy"]
        score = (WEIGHTS["completeness"] * complete + WEIGHTS["accuracy"] * accurate) / weight
        fresh = F.lit(None).cast("double")
    else:
        score = (WEIGHTS["freshness"] * fresh + WEIGHTS["completeness"] * complete
                 + WEIGHTS["accuracy"] * accurate)
    return {
        "freshness": F.round(fresh, 4), "completeness": F.round(complete, 4),
        "accuracy": F.round(accurate, 4), "score": F.round(score, 4),
        "status": F.when(score >= THRESHOLDS["green"], "green")
                   .when(score >= THRESHOLDS["amber"], "amber").otherwise("red")}


def vendor_scores(loads: DataFrame, *, as_of, mode: str = "live") -> DataFrame:
    """Scores per source from ``source, clean, rejected, latest, target_seconds``."""
    age = F.greatest((micros(instant(as_of)) - micros("latest")) / F.lit(float(SECOND)), F.lit(0.0))
    cols = score_columns(F.col("clean"), F.col("rejected"), age,
                         F.col("target_seconds").cast("double"), mode)
    return loads.select(instant(as_of).cast("date").alias("as_of"), "source",
                        *[c.alias(n) for n, c in cols.items()])


def degraded(scores: DataFrame, amber: float = THRESHOLDS["amber"]) -> DataFrame:
    """Sources whose latest score is under the line."""
    return latest_by(scores, ["source"], "as_of").where(F.col("score") < amber)


def latest_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    newest = versions_in_order(df, order)
    return df.groupBy(*keys).agg(*[
        (F.max(order) if c == order else F.max_by(c, newest)).alias(c) for c in rest])
