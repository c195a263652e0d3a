"""Steps whose memory in one task once grew faster than they needed."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare, connect
from tidemark.functions import quantiles
from tidemark.operators import contract as C
from tidemark.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_compared_tables_are_not_deduplicated_in_the_comparison(spark):
    df = QUERIES["i4_table_equality"](spark, SF)
    assert "min_by" not in plan(df) and "SortAggregate" not in plan(df)
    assert compare(connect(SF), df, ORACLES["i4_table_equality"]) == ""


def gate(df, arrival, *values):
    kinds = {"k": "int", "a": "float", "b": "string"}
    return C.gate(df, C.Contract.from_dict({
        "dataset": "d", "schema_version": "1", "grain": ["k"], "event_time_column": "at",
        "columns": [{"name": c, "type": kinds[c]} for c in ("k", *values)]}), now="2024-01-31", arrival=arrival)


def test_the_arrival_is_carried_once_through_deduplication(spark):
    rows = [(k, float(n), f"b{n}", f"t{(n + k) % 5}") for k in range(4) for n in range(5)]
    df = spark.createDataFrame(rows, "k int, a double, b string, at string")
    unique = gate(df, ["at"], "a", "b").unique
    first = {k: next((a, b) for j, a, b, at in rows if j == k and at == "t0") for k in range(4)}
    assert {r["k"]: (r["a"], r["b"]) for r in unique.collect()} == first
    assert plan(unique.select("k", "a", "b")).count("partial_min_by(") == 1


def test_deduplication_without_arrival_or_without_further_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (1, 1.0, "z"), (1, 1.0, "y"), (2, None, "w")], "k int, a double, b string")
    assert sorted(map(tuple, gate(df, [], "a", "b").clean.collect())) == [(1, 1.0, "y"), (2, None, "w")]
    assert sorted(map(tuple, gate(df, []).unique.collect())) == [(1, 3), (2, 1)]
    at = df.withColumn("at", F.lit("t"))
    assert sorted(map(tuple, gate(at, ["at"]).clean.collect())) == [(1,), (2,)]


def broadcast_lines(df) -> list[str]:
    """The lines of a plan below its broadcast exchanges."""
    out, inside = [], None
    for line in plan(df).splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        if inside is not None and depth > inside:
            out.append(line)
        else:
            inside = depth if "BroadcastExchange" in line else None
    return out


@pytest.mark.parametrize("few", [True, False])
def test_values_of_a_quantile_are_not_broadcast(spark, monkeypatch, few):
    made, written = [], quantiles.written
    monkeypatch.setattr(quantiles, "written", lambda df, label: made.append(df) or written(df, label))
    if not few:
        monkeypatch.setattr(quantiles, "within", lambda df: False)
        monkeypatch.setattr(quantiles, "small", lambda df: df)
    rows = [(f"k{i % 3}", float(i * i % 997)) for i in range(3000)]
    got = quantiles.exact_quantile(spark.createDataFrame(rows, "k string, v double"), ["k"], "v")
    want = {k: np.median([v for j, v in rows if j == k]) for k in ("k0", "k1", "k2")}
    assert {r["k"]: r["quantile"] for r in got.collect()} == want
    assert not [x for df in [*made, got] for x in broadcast_lines(df) if "FileScan" in x and "_v#" in x]
