"""Who may read what: a decision with its reason, for one read or for many requests."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.times import instant


class NotEntitled(PermissionError):
    pass


@dataclass(frozen=True)
class Policy:
    """``datasets``: name -> {licence, allow}; ``consumers``: name -> {allow_nothing}."""

    default_consumer: str = "research"
    datasets: dict = field(default_factory=dict)
    consumers: dict = field(default_factory=dict)

    def rules(self, spark: SparkSession) -> DataFrame:
        rows = [(d, r.get("licence", ""), list(r.get("allow", []))) for d, r in self.datasets.items()]
        return spark.createDataFrame(rows, "dataset string, licence string, allow array<string>")

    def barred(self) -> list[str]:
        return sorted(c for c, r in self.consumers.items() if (r or {}).get("allow_nothing"))

    def allows(self, consumer: str, dataset: str) -> tuple[bool, str]:
        if consumer in self.barred():
            return False, f"{consumer} may read nothing"
        rule = self.datasets.get(dataset)
        if rule is None:
            return False, f"no rule for {dataset}"
        if consumer in rule.get("allow", []):
            return True, rule.get("licence", "")
        return False, f"{consumer} is not allowed {dataset}"


def decide(requests: DataFrame, policy: Policy) -> DataFrame:
    """Decision and reason per request. A dataset nobody wrote a rule for is denied."""
    joined = requests.join(policy.rules(requests.sparkSession), "dataset", "left")
    barred = F.col("consumer").isin(policy.barred()) if policy.barred() else F.lit(False)
    listed = F.coalesce(F.array_contains("allow", F.col("consumer")), F.lit(False))
    reason = (
        F.when(barred, F.concat("consumer", F.lit(" may read nothing")))
        .when(F.col("allow").isNull(), F.concat(F.lit("no rule for "), "dataset"))
        .when(listed, F.col("licence"))
        .otherwise(F.concat("consumer", F.lit(" is not allowed "), "dataset")))
    return joined.select(*requests.columns, (listed & ~barred).alias("allowed"),
                         reason.alias("detail"))


def audit_rows(decisions: DataFrame, *, now, action: str = "read") -> DataFrame:
    """Log rows for allowed and refused reads alike."""
    return decisions.select(instant(now).alias("event_at"), "consumer", "dataset",
                            F.lit(action).alias("action"), "allowed", "detail")
