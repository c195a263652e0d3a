"""Running values along the rows of a key, for keys of any size.

Rows are range-partitioned and sorted by key and order, so that a large key lies in several
tasks. A running value is a monoid: lane k of the first d rows of a key is the sum of
v_i * B_k**i modulo p_k (or, without p_k, the plain sum), and two stretches are put together by
multiplying the later one with B_k to the length of the earlier. Each task scans its stretches in
one pass; what the stretches at its two ends amount to, at most two rows a task, is composed on
the driver and goes back as a table that small.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.taskcontext import TaskContext

from tidemark.session import written

Lane = tuple[int | None, int]
SUM: Lane = (None, 1)


def power(base: int, prime: int | None, exponent: np.ndarray) -> np.ndarray:
    """``base`` to each exponent, modulo ``prime``; 1 for plain sums."""
    out = np.ones(len(exponent), np.int64)
    if prime is None:
        return out
    square, left = base % prime, exponent.copy()
    while left.any():
        odd = (left & 1).astype(bool)
        out[odd] = out[odd] * square % prime
        square, left = square * square % prime, left >> 1
    return out


class Scan:
    """State of one task: the key it is in, its rows so far and their running values."""

    def __init__(self, lanes: list[Lane]):
        self.lanes = lanes
        self.key, self.rows, self.sums = None, 0, [0] * len(lanes)
        self.first = True

    def step(self, key: np.ndarray, values: list[np.ndarray]):
        """Places (from 1), values up to and before each row, and the last rows of the first key."""
        n = len(key)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        of = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]).astype(np.int64)]))
        goes_on = self.key is not None and key[0] == self.key
        place = np.arange(n) - starts[of] + 1
        if goes_on:
            place[of == 0] += self.rows
        upto, before = [], []
        for k, (prime, base) in enumerate(self.lanes):
            own = values[k] * power(base, prime, place)
            own = own % prime if prime else own
            run = np.cumsum(own)
            value = run - (run - own)[starts][of]
            if goes_on:
                value[of == 0] += self.sums[k]
            less = value - own
            upto.append(value % prime if prime else value)
            before.append(less % prime if prime else less)
        self.key, self.rows = int(key[-1]), int(place[-1])
        self.sums = [int(u[-1]) for u in upto]
        return place, upto, before

    def edges(self, key: np.ndarray, following: int | None) -> np.ndarray:
        """True at the last row of the task's first key and at its last row."""
        closes = np.zeros(len(key), bool)
        if self.first:
            other = np.flatnonzero(key != key[0])
            if len(other):
                closes[other[0] - 1] = True
                self.first = False
            elif following is None or following != key[0]:
                closes[-1] = True
                self.first = False
        if following is None:
            closes[-1] = True
        return closes


def running(df: DataFrame, key: str, order: list[str], values: list[str], lanes: list[Lane],
            label: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``place`` and, per lane, ``upto_k`` and ``before_k``; and the scratch table behind it.

    ``key`` is a long that is never null. Rows that agree in all of ``order`` must be
    interchangeable.
    """
    spark = df.sparkSession
    n = len(lanes)
    added = ["task int", "place bigint", "edge boolean", *(f"upto_{k} bigint" for k in range(n)),
             *(f"before_{k} bigint" for k in range(n))]
    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(", ".join(added)).fields)

    def run(batches):
        task = TaskContext.get().partitionId()
        scan, held = Scan(lanes), None
        for batch in (b for b in batches if b.num_rows):
            keys = batch.column(key).to_numpy()
            if held is not None:
                yield finished(scan, *held, int(keys[0]), task)
            held = batch, keys, scan.step(keys, [batch.column(v).to_numpy() for v in values])
        if held is not None:
            yield finished(scan, *held, None, task)

    def finished(scan, batch, keys, found, following, task):
        place, upto, before = found
        columns = [*batch.columns, pa.array(np.full(len(keys), task, np.int32)), pa.array(place),
                   pa.array(scan.edges(keys, following)), *map(pa.array, upto), *map(pa.array, before)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = written(df.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
                    .mapInArrow(run, schema), label)
    edges = table.where("edge").select(key, "task", "place", *(f"upto_{k}" for k in range(n))).collect()
    carried = spark.createDataFrame(composed([tuple(r) for r in edges], lanes), ", ".join(
        [f"{key} bigint", "task int", "rows_ bigint", *(f"sum_{k} bigint" for k in range(n)),
         *(f"power_{k} bigint" for k in range(n))]))
    joined = table.join(F.broadcast(carried), [key, "task"], "left")

    def whole(k: int, name: str):
        prime = lanes[k][0]
        total = F.coalesce(F.col(f"sum_{k}"), F.lit(0)) + F.coalesce(
            F.col(f"power_{k}"), F.lit(1)) * F.col(f"{name}_{k}")
        return (total % prime if prime else total).alias(f"{name}_{k}")

    return joined.select(*df.columns, (F.col("place") + F.coalesce("rows_", F.lit(0))).alias("place"),
                         *(whole(k, "upto") for k in range(n)),
                         *(whole(k, "before") for k in range(n))), table


def composed(edges: list[tuple], lanes: list[Lane]) -> list[tuple]:
    """For each stretch that goes on a key of an earlier task: what the key holds before it."""
    state: dict[int, tuple[int, list[int]]] = {}
    out = []
    for key, task, rows, *sums in sorted(edges, key=lambda e: (e[1], e[0])):
        if key in state:
            count, total = state[key]
            powers = [pow(base, count, prime) if prime else 1 for prime, base in lanes]
            out.append((key, task, count, *total, *powers))
            total = [(t + w * s) % prime if prime else t + s
                     for t, w, s, (prime, _) in zip(total, powers, sums, lanes)]
            state[key] = count + rows, total
        else:
            state[key] = rows, list(sums)
    return out
