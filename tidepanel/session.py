"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Rows that a task of a step that holds all its rows may have.
ROWS_AT_ONCE = 500_000


def tasks_for(spark: SparkSession, rows: int, most: int = ROWS_AT_ONCE) -> int:
    """So many tasks that none has much more than `most` rows; at least one per core."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / most))


def dealt_out(df: DataFrame, most: int = ROWS_AT_ONCE) -> DataFrame:
    """A stored table, dealt anew where a task that reads it would have more than `most` rows.

    Columns of few values make files small, so that a split by bytes has many rows.
    """
    needed = math.ceil(df.count() / most)
    if df.rdd.getNumPartitions() >= needed:
        return df
    return df.repartition(needed, F.monotonically_increasing_id())


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC days and ANSI casts."""
    builder = (
        SparkSession.builder.appName("tidepanel")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.legacy.javaCharsets", "true")
    )
    if master:
        builder = builder.master(master)
    for key, val in conf.items():
        builder = builder.config(key.replace("__", "."), val)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session, whose executors share the driver's disk, may fall
    back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tidepanel-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidepanel-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder and read on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write `df` as Parquet below the shared folder and read it back.

    For a table read several times: later reads prune columns, push filters
    down and survive the loss of any executor. `codec` is the compression, by
    default Spark's.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
