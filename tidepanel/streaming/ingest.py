"""Incremental ingest of new raw files, and the daily aggregate kept up to date."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel.sinks.stores import publish
from tidepanel.sources.stores import current_path, published


def _stored_rows(spark: SparkSession, path: str, schema) -> int:
    """Rows of a Parquet folder, out of its footers; none if there is no folder yet."""
    try:
        return spark.read.schema(schema).parquet(path).count()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return 0
        raise


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema,
    fmt: str = "parquet",
    files_per_batch: int = 1000,
    **options,
) -> int:
    """Append every file not seen before to `target`, then stop; returns the rows added.

    The checkpoint records the files done, so a rerun copies only new ones and
    a crashed run resumes without loss or repeats.
    """
    before = _stored_rows(spark, target, schema)
    stream = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .options(**options)
        .load(source)
    )
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _stored_rows(spark, target, schema) - before


def daily_totals_stream(
    events: DataFrame, ts: str, entity: str, value: str, lateness: str = "7 days"
) -> DataFrame:
    """Streaming daily sums per entity; rows later than `lateness` are dropped.

    State holds one row per (day, entity) inside the watermark.
    """
    return (
        events.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, lateness)
        .groupBy(F.window(ts, "1 day").alias("w"), F.col(entity))
        .agg(F.sum(value).alias("value"), F.count(F.lit(1)).alias("n"))
        .select(F.to_date(F.col("w.start")).alias("day"), entity, "value", "n")
    )


def run_daily_totals(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema,
    ts: str,
    entity: str,
    value: str,
    lateness: str = "7 days",
    **options,
) -> None:
    """Fold the available files into closed days of `target` (days past the watermark)."""
    events = spark.readStream.schema(schema).options(**options).parquet(source)
    query = (
        daily_totals_stream(events, ts, entity, value, lateness)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


#: Sums of one batch, and when its latest event was.
SUMS = "day date, entity string, value double, n long"
MARK = "latest timestamp"


def _batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table with a folder per batch; empty while there is none."""
    try:
        return spark.read.schema(f"{schema}, batch long").parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], f"{schema}, batch long")


def upsert_batch(
    rows: DataFrame, batch: int, target: str, ts: str, entity: str, value: str, lateness: str = "7 days"
) -> None:
    """Fold one batch of events into the totals below `target`, however often it is replayed.

    The batch's sums per (day, entity) overwrite the folder of its number, so a
    replay changes nothing. Rows of days that the batches before had closed, by the
    latest event so far less `lateness`, count in the totals all the same, and are
    kept in the side table `late`.
    """
    spark = rows.sparkSession
    marks = _batches(spark, f"{target}/marks", MARK).filter(F.col("batch") < batch)
    closed = marks.agg((F.max("latest") - F.expr(f"INTERVAL {lateness}")).alias("closed")).first()["closed"]
    events = rows.select(
        F.col(ts).cast("timestamp").alias("ts"), F.col(entity).cast("string").alias("entity"),
        F.col(value).cast("double").alias("value"),
    ).filter(F.col("ts").isNotNull())
    day = F.to_date("ts")
    late = events.filter(F.date_add(day, 1) <= F.lit(closed)) if closed is not None else events.limit(0)
    late.write.mode("overwrite").parquet(f"{target}/late/batch={batch}")
    events.groupBy(day.alias("day"), "entity").agg(
        F.sum("value").alias("value"), F.count(F.lit(1)).alias("n")
    ).write.mode("overwrite").parquet(f"{target}/sums/batch={batch}")
    events.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(f"{target}/marks/batch={batch}")


def run_upserts(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema, ts: str, entity: str, value: str,
    lateness: str = "7 days", files_per_batch: int = 1000, **options,
) -> None:
    """Fold all files not seen before into the totals, batch by batch, then stop."""
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).options(**options).parquet(source)
    query = (
        events.writeStream.foreachBatch(lambda rows, batch: upsert_batch(rows, batch, target, ts, entity, value, lateness))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _folded(spark: SparkSession, target: str) -> tuple[DataFrame, int]:
    """Totals that were compacted, and the last batch in them."""
    base = f"{target}/compacted"
    try:
        path = current_path(spark, base)
    except FileNotFoundError:
        return spark.createDataFrame([], SUMS), -1
    note = published(spark, base).orderBy(F.desc("published"), F.desc("version")).first()["note"]
    return spark.read.schema(SUMS).parquet(path), int(note)


def upserted_totals(spark: SparkSession, target: str) -> DataFrame:
    """(day, entity, value, n) of all rows so far, late ones too."""
    folded, last = _folded(spark, target)
    newer = _batches(spark, f"{target}/sums", SUMS).filter(F.col("batch") > last).drop("batch")
    return folded.unionByName(newer).groupBy("day", "entity").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))


def compact_totals(spark: SparkSession, target: str) -> None:
    """Publish the totals of all finished batches as one table, so that reads don't grow with the batches."""
    last = _batches(spark, f"{target}/marks", MARK).agg(F.max("batch")).first()[0]
    if last is None:
        return
    folded, before = _folded(spark, target)
    newer = _batches(spark, f"{target}/sums", SUMS).filter(F.col("batch").between(before + 1, last)).drop("batch")
    totals = folded.unionByName(newer).groupBy("day", "entity").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    publish(spark, f"{target}/compacted", lambda path: totals.write.parquet(path), str(last))


def late_rows(spark: SparkSession, target: str) -> DataFrame:
    """(ts, entity, value, batch) of the rows that came after their day was closed."""
    return _batches(spark, f"{target}/late", "ts timestamp, entity string, value double")
