"""Entity resolution: ids that name one place, and hubs of several places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.functions import text
from tidepanel.operators.components import connected_components
from tidepanel.session import cut_lineage


def lifetimes(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """First day, last day and number of rows of every id."""
    return panel.groupBy(cols.entity).agg(
        F.min(cols.day).alias("first_day"),
        F.max(cols.day).alias("last_day"),
        F.count(F.lit(1)).alias("n_days"),
    )


def label_lifetimes(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """`lifetimes` per (id, label): one pass over the panel feeds all of detection."""
    return panel.groupBy(cols.entity, cols.label).agg(
        F.min(cols.day).alias("first_day"),
        F.max(cols.day).alias("last_day"),
        F.count(F.lit(1)).alias("n_days"),
    )


def key_id_pairs(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """Distinct (key, id); rows without a label join no group."""
    pairs = panel.select(cols.label, cols.entity).filter(F.col(cols.label).isNotNull()).distinct()
    keys = (
        pairs.select(cols.label).distinct().withColumn("key", text.label_key(F.col(cols.label)))
    )
    return pairs.join(keys, cols.label).select("key", cols.entity).distinct()


def ids_per_key(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """Number, smallest and largest of the ids that carry each key.

    The pairs themselves stay in long form (`key_id_pairs`), so a key shared by
    very many ids is never gathered into one array.
    """
    return (
        key_id_pairs(panel, cols)
        .groupBy("key")
        .agg(
            F.count(cols.entity).alias("n_ids"),
            F.min(cols.entity).alias("min_id"),
            F.max(cols.entity).alias("max_id"),
        )
    )


def group_keys(pairs: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """(key, id, group): keys sharing an id are united; the group is its smallest key.

    Each key is linked to the smallest key of each of its ids, which spans the
    same components as all pairs of keys do, with one edge per (key, id).
    """
    head = pairs.groupBy(cols.entity).agg(F.min("key").alias("b"))
    edges = pairs.join(head, cols.entity).select(F.col("key").alias("a"), "b")
    nodes = pairs.select(F.col("key").alias("node")).distinct()
    groups = connected_components(nodes, edges).select(
        F.col("node").alias("key"), F.col("component").alias("group")
    )
    return pairs.join(groups, "key")


def max_overlap_days(lives: DataFrame, group: str = "group") -> DataFrame:
    """Largest pairwise overlap, in days, of the lifetimes in each group; at least 0.

    Sorted by first day, the best partner of a lifetime among the earlier ones
    is the one ending last, so a running maximum replaces the self join. Only
    the two latest ends per (group, first day) can matter, which bounds the
    window by the number of days however many ids a group has.
    """
    latest = Window.partitionBy(group, "first_day").orderBy(F.desc("last_day"))
    ends = (
        lives.select(group, "first_day", "last_day")
        .withColumn("r", F.row_number().over(latest))
        .filter(F.col("r") <= 2)
        .groupBy(group, "first_day")
        .agg(
            F.max("last_day").alias("end1"),
            F.max(F.when(F.col("r") == 2, F.col("last_day"))).alias("end2"),
        )
    )
    before = Window.partitionBy(group).orderBy("first_day").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # least() skips NULL, so each partner is guarded by itself.
    earlier = F.max("end1").over(before)
    with_earlier = F.when(
        earlier.isNotNull(), F.datediff(F.least(earlier, F.col("end1")), F.col("first_day"))
    )
    same_start = F.datediff(F.col("end2"), F.col("first_day"))
    best = ends.select(group, F.greatest(with_earlier, same_start).alias("overlap"))
    return best.groupBy(group).agg(
        F.greatest(F.lit(0), F.coalesce(F.max("overlap"), F.lit(0))).alias("overlap")
    )


def common_window(lives: DataFrame, group: str = "group") -> DataFrame:
    """[latest first day, earliest last day] of each group."""
    return lives.groupBy(group).agg(
        F.max("first_day").alias("start"), F.min("last_day").alias("end")
    )


def means_on_common_window(
    panel: DataFrame, members: DataFrame, windows: DataFrame, cols: PanelCols = DEFAULT
) -> DataFrame:
    """Mean value per (group, id) over the group's common window; empty windows give no row."""
    bounds = members.join(windows.filter(F.col("start") <= F.col("end")), "group")
    return (
        panel.select(cols.entity, cols.day, cols.value)
        .join(bounds, cols.entity)
        .filter(F.col(cols.day).between(F.col("start"), F.col("end")))
        .groupBy("group", cols.entity)
        .agg(F.avg(cols.value).alias("mean"))
    )


def override_table(spark: SparkSession, overrides: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(overrides.items()), "key string, forced string")


def detect_actions(
    panel: DataFrame,
    overlap_days: int = config.OVERLAP_DAYS,
    duplicate_ratio: float = config.DUPLICATE_RATIO,
    overrides: dict[str, str] = config.ACTION_OVERRIDES,
    summary: DataFrame | None = None,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """(id, target, action, group, canonical, overlap) of every id in a multi-id group.

    Successive ids are summed; overlapping ids are summed when their volumes
    differ and reduced to the daily maximum when they look like duplicates. An
    override named by any key of the group wins; the action `skip` drops it.
    """
    # The panel is read twice: for this summary and for the common-window means.
    if summary is None:
        summary = cut_lineage(label_lifetimes(panel, cols))
    grouped = cut_lineage(group_keys(key_id_pairs(summary, cols), cols))
    whole = summary.groupBy(cols.entity).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    )
    return decide_actions(panel, grouped, whole, overlap_days, duplicate_ratio, overrides, cols)


def decide_actions(
    panel: DataFrame,
    grouped: DataFrame,
    whole: DataFrame,
    overlap_days: int = config.OVERLAP_DAYS,
    duplicate_ratio: float = config.DUPLICATE_RATIO,
    overrides: dict[str, str] = config.ACTION_OVERRIDES,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """`detect_actions` for given groups (key, id, group) and lifetimes of their ids."""
    whole = whole.select(cols.entity, "first_day", "last_day")
    members = grouped.select("group", cols.entity).distinct()
    multi = members.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    members = members.join(multi.select("group"), "group", "left_semi")
    lives = members.join(whole, cols.entity)

    per_group = lives.groupBy("group").agg(
        F.max_by(cols.entity, F.struct("last_day", cols.entity)).alias("target")
    )
    names = grouped.groupBy("group").agg(
        F.min_by("key", F.struct(-F.length("key"), F.col("key"))).alias("canonical")
    )
    overlap = max_overlap_days(lives)
    means = means_on_common_window(panel, members, common_window(lives), cols)
    ratio = means.groupBy("group").agg(
        F.min("mean").alias("low"), F.max("mean").alias("high")
    )
    decided = (
        per_group.join(names, "group").join(overlap, "group").join(ratio, "group", "left")
    )
    if overrides:
        spark = panel.sparkSession
        forced = (
            grouped.select("group", "key")
            .distinct()
            .join(F.broadcast(override_table(spark, overrides)), "key")
            .groupBy("group")
            .agg(F.min_by("forced", "key").alias("forced"))
        )
        decided = decided.join(forced, "group", "left")
    else:
        decided = decided.withColumn("forced", F.lit(None).cast("string"))

    unknown = F.col("high").isNull() | (F.col("high") == 0)
    # Evaluated last in the chain, so the divisor is never 0.
    duplicate = F.col("low") / F.col("high") >= F.lit(duplicate_ratio)
    automatic = (
        F.when(F.col("overlap") < overlap_days, "merge_sum")
        .when(unknown, "merge_max")
        .when(duplicate, "merge_max")
        .otherwise("merge_sum")
    )
    decided = decided.withColumn("action", F.coalesce("forced", automatic)).filter(
        F.col("action") != "skip"
    )
    return members.join(decided, "group").select(
        cols.entity, "target", "action", "group", "canonical", "overlap"
    )


def _moved(panel: DataFrame, actions: DataFrame, cols: PanelCols) -> DataFrame:
    joined = panel.join(actions.select(cols.entity, "target", "action"), cols.entity, "left")
    return joined.select(
        cols.day,
        F.coalesce("target", cols.entity).alias(cols.entity),
        cols.value,
        cols.label,
        F.col(cols.entity).alias("source_id"),
        F.coalesce("action", F.lit("keep")).alias("action"),
    )


def _daily_maximum(moved: DataFrame, cols: PanelCols) -> DataFrame:
    last = F.when(F.col(cols.label).isNotNull(), F.col("source_id"))
    return (
        moved.filter(F.col("action") == "merge_max")
        .groupBy(cols.day, cols.entity)
        .agg(
            F.max(cols.value).alias(cols.value),
            F.max_by(cols.label, last).alias(cols.label),
            F.max("source_id").alias("source_id"),
        )
    )


def apply_actions(panel: DataFrame, actions: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """Move ids to their target; rows of merge_max groups become one daily maximum.

    Other rows pass through unsummed with their original id as `source_id`,
    because hub detection still reads each of their labels.
    """
    moved = _moved(panel, actions, cols)
    rest = moved.filter(F.col("action") != "merge_max").drop("action")
    return _daily_maximum(moved, cols).unionByName(rest)


def hub_table(spark: SparkSession, hubs: dict[str, list[str]], base: int) -> DataFrame:
    """(key, hub_id, hub_name); hub ids count down from `base`."""
    rows = [
        (key, base - i, name) for i, (name, keys) in enumerate(hubs.items()) for key in keys
    ]
    return spark.createDataFrame(rows, "key string, hub_id bigint, hub_name string")


def hub_members(panel: DataFrame, hubs: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """(id, hub_id, hub_name): an id that ever carries a hub label belongs to the hub.

    If its labels name several hubs the one defined last wins (lowest hub id).
    Any table with the id and label columns will do.
    """
    return (
        key_id_pairs(panel, cols)
        .join(F.broadcast(hubs), "key")
        .groupBy(cols.entity)
        .agg(F.min("hub_id").alias("hub_id"), F.min_by("hub_name", "hub_id").alias("hub_name"))
    )


def apply_hubs(panel: DataFrame, members: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """Give hub members the hub's synthetic id and label, over their full history."""
    joined = panel.join(members, cols.entity, "left")
    return joined.withColumns(
        {
            cols.entity: F.coalesce("hub_id", cols.entity),
            cols.label: F.coalesce("hub_name", cols.label),
        }
    ).drop("hub_id", "hub_name")


def sum_by_key(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """One row per (day, entity): summed value, label of the greatest source id."""
    last = F.when(F.col(cols.label).isNotNull(), F.col("source_id"))
    return panel.groupBy(cols.day, cols.entity).agg(
        F.sum(cols.value).alias(cols.value), F.max_by(cols.label, last).alias(cols.label)
    )


def merge_entities(
    panel: DataFrame,
    overlap_days: int = config.OVERLAP_DAYS,
    duplicate_ratio: float = config.DUPLICATE_RATIO,
    overrides: dict[str, str] = config.ACTION_OVERRIDES,
    hubs: dict[str, list[str]] = config.HUBS,
    hub_id_base: int = config.HUB_ID_BASE,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """Resolve multi-id entities, then hubs; (day, entity) is unique afterwards.

    Equals `apply_actions`, `apply_hubs` and `sum_by_key` in turn. A target is
    either reduced to maxima or summed as a whole, so both happen in one
    aggregate per (day, target), and hub membership of summed ids is read off
    the label summary instead of the rows. The panel is read several times:
    pass a stored table (session.materialize).
    """
    summary = cut_lineage(label_lifetimes(panel, cols))
    actions = cut_lineage(
        detect_actions(panel, overlap_days, duplicate_ratio, overrides, summary, cols)
    )
    moved = _moved(panel, actions, cols)
    labelled = F.when(F.col(cols.label).isNotNull(), F.col("source_id"))
    merged = moved.groupBy(cols.day, cols.entity).agg(
        F.when(F.max("action") == "merge_max", F.max(cols.value))
        .otherwise(F.sum(cols.value))
        .alias(cols.value),
        F.max_by(cols.label, labelled).alias(cols.label),
        F.max(labelled).alias("source_id"),
    )
    if not hubs:
        return merged.drop("source_id")
    chosen = actions.select(cols.entity, "target", "action")
    carried = summary.join(chosen, cols.entity, "left").filter(
        F.coalesce("action", F.lit("keep")) != "merge_max"
    )
    labels = carried.select(F.coalesce("target", cols.entity).alias(cols.entity), cols.label)
    kept = _daily_maximum(moved, cols).select(cols.entity, cols.label).distinct()
    table = hub_table(panel.sparkSession, hubs, hub_id_base)
    members = hub_members(labels.unionByName(kept), table, cols)
    return sum_by_key(apply_hubs(merged, members, cols), cols)
