"""Streaming twins: incremental load, replay removal, bars and late rows.

Rows may come in any order of time: nothing is dropped for being late.

The query's checkpoint is the cursor. Batch sinks write to a folder named after the
batch, so a batch that is run again after a failure replaces its own output.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.functions.times import instant
from tidemark.operators.bars import TRADE_GRAIN, ohlcv
from tidemark.session import scratch_dir
from tidemark.sources import snapshots


def file_stream(spark: SparkSession, path: str, schema: StructType, *, fmt: str = "parquet",
                pattern: str | None = None, files_per_batch: int | None = None,
                **options: str) -> DataFrame:
    """A folder as a stream: each visible file once, hidden and partial names never."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options).option(
        "recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(path)


def drain(writer: DataStreamWriter, checkpoint: str, *, every: str | None = None):
    """Process what is there and stop, or keep polling when an interval is given."""
    writer = writer.option("checkpointLocation", checkpoint)
    query = (writer.trigger(processingTime=every) if every
             else writer.trigger(availableNow=True)).start()
    if not every:
        query.awaitTermination()
    return query


def to_table(stream: DataFrame, path: str, checkpoint: str, *, every: str | None = None):
    return drain(stream.writeStream.format("parquet").option("path", path).outputMode("append"),
                 checkpoint, every=every)


def per_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, *,
              every: str | None = None):
    return drain(stream.writeStream.foreachBatch(handle), checkpoint, every=every)


def keep_new(stream: DataFrame, path: str, checkpoint: str, *, partition: str,
             grain: Sequence[str] = TRADE_GRAIN, name: str = "keep", every: str | None = None):
    """A replayed row collapses onto the first, however late it comes.

    The table is the state: a batch is held against the keys of those days alone whose bounds it
    meets. No state is kept in memory or in a state store.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        snapshots.add_new(batch.sparkSession, path, batch, grain, partition, f"{name}-{batch_id}")

    return per_batch(stream, handle, checkpoint, every=every)


def keep_bars(stream: DataFrame, trades: str, bars: str, checkpoint: str, *, freq: str = "15m",
              grain: Sequence[str] = TRADE_GRAIN, time: str = "ts", name: str = "bars",
              every: str | None = None):
    """Trades merged into a keyed table by day, and the bars of the days a batch changed.

    Replays, corrections and late trades come out as in a batch run over all rows, a trade that
    moved to another day included. A batch that broke off between the two tables finds the days in
    the history of the first.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, f"{name}-{batch_id}"
        snapshots.upsert(spark, trades, batch.withColumn("trade_day", F.to_date(time)), grain, "trade_day", run)
        version = snapshots.version_of(spark, trades, run)
        if version is None:
            return
        days = snapshots.changed(spark, trades, version)
        rows = ohlcv(snapshots.read_parts(spark, trades, days), freq, time=time, deduplicated=True)
        snapshots.replace(spark, bars, rows.withColumn("trade_day", F.to_date("bucket")),
                          ["venue", "symbol", "bucket"], "trade_day", run, parts=days)

    return per_batch(stream, handle, checkpoint, every=every)


def route_rows(batch: DataFrame, *, now, mark=None, horizon_seconds: int = 60,
               time: str = "ts") -> DataFrame:
    """``future`` rows are refused, rows behind the mark are kept and named ``late``."""
    limit = instant(now) + F.expr(f"INTERVAL {horizon_seconds} SECONDS")
    late = F.lit(False) if mark is None else F.coalesce(
        F.col(time) < instant(mark), F.lit(False))
    return batch.withColumn("route", F.when(F.col(time) > limit, "future").when(
        late, "late").otherwise("accepted"))


def route_stream(stream: DataFrame, out: str, checkpoint: str, *, now,
                 allowed_delay: str = "10 minutes", time: str = "ts", every: str | None = None):
    """Split a stream by :func:`route_rows`; the mark is the newest accepted row so far, kept
    next to the output, minus the allowed delay."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = before = None
        if batch_id > 0:
            seen = spark.read.parquet(f"{out}/marks/batch={batch_id - 1}").select(
                "newest", (F.col("newest") - F.expr(f"INTERVAL {allowed_delay}")).alias("m")).first()
            before, mark = seen["newest"], seen["m"]
        routed = route_rows(batch, now=now, mark=mark, time=time)
        routed.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")
        stored = spark.read.schema(routed.schema).parquet(f"{out}/rows/batch={batch_id}")
        newest = F.max(F.when(F.col("route") != "future", F.col(time)))
        kind = dict(routed.dtypes)[time]
        stored.agg(F.greatest(newest, F.lit(before).cast(kind)).alias("newest")).write.mode(
            "overwrite").parquet(f"{out}/marks/batch={batch_id}")

    return per_batch(stream, handle, checkpoint, every=every)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """What the batch sinks wrote, all batches together."""
    return spark.read.parquet(f"{path}/batch=*")


def workspace(spark: SparkSession, label: str) -> tuple[str, str]:
    """Output and checkpoint folders for one query, both under the shared folder."""
    root = scratch_dir(spark, label)
    return f"{root}/out", f"{root}/checkpoint"
