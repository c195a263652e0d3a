"""Session construction and the two settings every job relies on."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Row bound under which a side may be broadcast after it was counted.
BROADCAST_ROWS = 200_000


def build_session(app: str = "tidemark", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; cluster settings win when present."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Instants are compared with naive timestamps throughout, so the zone is fixed."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only in local mode.

    The setting itself cannot be changed while a session runs, so the temporary folder is
    given to the context, which keeps it for later calls.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = current.get() if current.isDefined() else None
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one write."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a table in the shared folder, readable by every executor.

    :func:`discard` takes the table away once what was made from it is written itself.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written`; nothing that is still to run may read them."""
    for table in tables:
        remove(table.sparkSession, table.scratch_path)
    if tables:
        collect_garbage(tables[0].sparkSession)


def collect_garbage(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go when the driver's garbage is collected, which a small driver
    may put off for long; it is asked to here."""
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system that Spark can reach."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def versions_in_order(df: DataFrame, column: str) -> Column:
    """An ordering by a column that is never null: rows without a version come before all others.

    Dates and times stay primitive, so that aggregates over them can hash.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(F.col(column), F.lit("0001-01-01").cast(kind))
    return F.struct(column)


def within(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when the frame was counted to hold at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame) -> DataFrame:
    """The frame marked for broadcast if it was counted to be small, otherwise as it is."""
    return F.broadcast(df) if within(df) else df
