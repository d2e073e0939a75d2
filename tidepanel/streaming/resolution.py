"""Entity resolution kept up to date as panel rows arrive, batch by batch.

A version of the state holds three tables: `pairs` (key, id, group), `lives`
(id, first day, last day, number of rows) and `actions` of ids in groups of
several. A batch adds its distinct (key, id) pairs: known groups stand for all
their keys, so the components are those of a graph with an edge per new pair, and groups
that no new pair meets stay as they are. Actions are decided again for groups
with an id in the batch alone, from the daily sums of their ids.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.operators import entities
from tidepanel.operators.components import connected_components
from tidepanel.operators.joins import broadcast_if_small
from tidepanel.session import cut_lineage
from tidepanel.sinks.stores import publish, version_path
from tidepanel.sources.stores import published


def _version(spark: SparkSession, base: str, before: int | None = None) -> str | None:
    """The path of the state after the latest batch, or after the latest one before `before`."""
    try:
        log = published(spark, base).withColumn("batch", F.col("note").cast("long"))
    except FileNotFoundError:
        return None
    if before is not None:
        log = log.filter(F.col("batch") < before)
    row = log.orderBy(F.desc("batch"), F.desc("published"), F.desc("version")).first()
    return row and version_path(base, row["version"])


def _schemas(id_type: str, cols: PanelCols) -> dict[str, str]:
    own = f"`{cols.entity}` {id_type}"
    return {
        "pairs": f"key string, {own}, `group` string",
        "lives": f"{own}, first_day date, last_day date, n_days long",
        "actions": f"{own}, target {id_type}, action string, `group` string, canonical string, overlap int",
    }


def _stored(spark: SparkSession, path: str | None, name: str, schema: str) -> DataFrame:
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def grown_groups(pairs: DataFrame, new: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """(key, id, group) of the known `pairs` and the `new` (key, id) pairs, none of which is known.

    A new pair links the group of its key to the group of its id; a key without
    a group stands for itself, and an id without one takes the smallest of its new pairs'.
    A group is the smallest key in it, so the smallest node of a component is
    again its smallest key.
    """
    of_key = pairs.join(new.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min("group").alias("known_key"))
    of_id = pairs.join(new.select(cols.entity).distinct(), cols.entity, "left_semi").groupBy(cols.entity).agg(
        F.min("group").alias("known_id")
    )
    ends = cut_lineage(
        new.join(of_key, "key", "left").join(of_id, cols.entity, "left")
        .select("key", cols.entity, F.coalesce("known_key", "key").alias("a"), "known_id")
    )
    heads = ends.groupBy(cols.entity).agg(F.coalesce(F.max("known_id"), F.min("a")).alias("b"))
    edges = ends.join(heads, cols.entity).select("a", "b")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    parts = cut_lineage(connected_components(nodes, edges))
    moved = broadcast_if_small(parts.filter(F.col("node") != F.col("component")).withColumnRenamed("node", "group"))
    kept = pairs.join(moved, "group", "left").select("key", cols.entity, F.coalesce("component", "group").alias("group"))
    added = ends.join(parts, ends["a"] == parts["node"]).select("key", cols.entity, F.col("component").alias("group"))
    return kept.unionByName(added)


def grown_lives(lives: DataFrame, summary: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """First and last day and number of rows of all ids, with those of a batch's summary."""
    both = lives.unionByName(summary.select(cols.entity, "first_day", "last_day", "n_days"))
    return both.groupBy(cols.entity).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.sum("n_days").alias("n_days")
    )


def _daily(spark: SparkSession, base: str, batch: int, id_type: str, cols: PanelCols) -> DataFrame:
    """Sums per (id, day) and batch, up to this batch."""
    schema = f"`{cols.entity}` {id_type}, `{cols.day}` date, `{cols.value}` double, batch long"
    return spark.read.schema(schema).parquet(f"{base}/daily").filter(F.col("batch") <= batch)


def resolve_batch(
    rows: DataFrame,
    batch: int,
    base: str,
    overlap_days: int = config.OVERLAP_DAYS,
    duplicate_ratio: float = config.DUPLICATE_RATIO,
    overrides: dict[str, str] = config.ACTION_OVERRIDES,
    cols: PanelCols = DEFAULT,
) -> None:
    """Fold one batch of panel rows into the state below `base`, however often it is replayed.

    A version starts from the one of an earlier batch and its daily sums are a
    folder of its own, so a replay gives the same state. Rows without id, day or
    value are left out; an (id, day) that comes in several batches counts as several rows
    of its life, and its values are summed.
    """
    spark = rows.sparkSession
    id_type = rows.schema[cols.entity].dataType.simpleString()
    rows = rows.dropna(subset=[cols.entity, cols.day, cols.value])
    rows.groupBy(cols.entity, cols.day).agg(F.sum(cols.value).cast("double").alias(cols.value)).write.mode(
        "overwrite"
    ).parquet(f"{base}/daily/batch={batch}")

    before, schemas = _version(spark, base, batch), _schemas(id_type, cols)
    pairs, lives, actions = (_stored(spark, before, name, schema) for name, schema in schemas.items())
    summary = cut_lineage(entities.label_lifetimes(rows, cols))
    new = cut_lineage(entities.key_id_pairs(summary, cols).join(pairs, ["key", cols.entity], "left_anti"))
    grouped = pairs if new.isEmpty() else grown_groups(pairs, new, cols)

    def write(path: str) -> None:
        grouped.write.parquet(f"{path}/pairs")
        grown_lives(lives, summary, cols).write.parquet(f"{path}/lives")
        now, alive = (_stored(spark, path, name, schemas[name]) for name in ("pairs", "lives"))
        seen = summary.select(cols.entity).distinct()
        changed = cut_lineage(now.join(seen, cols.entity, "left_semi").select("group").distinct())
        touched = cut_lineage(now.join(broadcast_if_small(changed), "group", "left_semi"))
        ids = touched.select(cols.entity).distinct()
        panel = (
            _daily(spark, base, batch, id_type, cols).join(broadcast_if_small(ids), cols.entity, "left_semi")
            .groupBy(cols.entity, cols.day).agg(F.sum(cols.value).alias(cols.value))
        )
        decided = entities.decide_actions(
            panel, touched, alive.join(ids, cols.entity, "left_semi"), overlap_days, duplicate_ratio, overrides, cols
        )
        # An action of a group that was united with another goes by its ids.
        rest = actions.join(ids, cols.entity, "left_anti")
        rest.unionByName(decided).write.parquet(f"{path}/actions")

    publish(spark, base, write, str(batch))


def run_resolution(
    spark: SparkSession, source: str, base: str, checkpoint: str, schema, files_per_batch: int = 1000, **options
) -> None:
    """Fold all files of panel rows not seen before into the state, batch by batch, then stop.

    `options` are those of `resolve_batch`.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (
        rows.writeStream.foreachBatch(lambda part, batch: resolve_batch(part, batch, base, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def resolved(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables `pairs`, `lives` and `actions` after the latest batch."""
    path = _version(spark, base)
    if path is None:
        raise FileNotFoundError(f"nothing is published at {base}")
    try:
        return {name: spark.read.parquet(f"{path}/{name}") for name in ("pairs", "lives", "actions")}
    except AnalysisException as error:
        raise FileNotFoundError(f"no state at {path}") from error
