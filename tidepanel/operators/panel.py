"""From facts to the daily panel, plus quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.session import tasks_for


def daily_panel(
    facts: DataFrame, count: str = "NB_VALD", cols: PanelCols = DEFAULT, first_by: Column | None = None
) -> DataFrame:
    """One row per (day, entity): summed count and the first non-null label.

    Rows carry no order in Spark, so "first" is the smallest `first_by`
    (by default the label itself). Both aggregates combine before the shuffle,
    so an entity with a third of the facts costs no more than any other.
    """
    order = F.col(cols.label) if first_by is None else first_by
    usable = facts.dropna(subset=[cols.entity, count])
    return usable.groupBy(cols.day, cols.entity).agg(
        F.sum(count).alias(cols.value),
        F.min_by(cols.label, F.when(F.col(cols.label).isNotNull(), order)).alias(cols.label),
    )


def quality_report(
    facts: DataFrame,
    panel: DataFrame,
    count: str = "NB_VALD",
    cols: PanelCols = DEFAULT,
    sentinels=tuple(config.SENTINEL_IDS),
) -> DataFrame:
    """Check names and values of the cleaned facts and of the panel, in long form."""
    e, d, v = F.col(cols.entity), F.col(cols.day), F.col(cols.value)

    def as_long(row: DataFrame) -> DataFrame:
        pairs = [
            F.struct(F.lit(c).alias("check"), F.col(c).cast("string").alias("value"))
            for c in row.columns
        ]
        return row.select(F.inline(F.array(*pairs)))

    fact_row = facts.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(d.isNull()).alias("fact_null_days"),
        F.count_if(e.isNull()).alias("fact_null_ids"),
        F.count_if(F.col(count).isNull()).alias("fact_null_counts"),
        F.min(count).cast("bigint").alias("fact_min_count"),
        F.max(count).cast("bigint").alias("fact_max_count"),
        F.min(d).alias("fact_first_day"),
        F.max(d).alias("fact_last_day"),
    )
    # Group first: distinct entities and duplicate keys then need no exact
    # distinct over raw rows. The panel is dealt anew, so that its own groups and
    # these are not held by one task together.
    tasks = tasks_for(panel.sparkSession, facts.count())
    per_key = panel.select(cols.entity, cols.day, cols.value).repartition(tasks, cols.entity, cols.day).groupBy(cols.entity, cols.day).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("low")
    )
    per_entity = per_key.groupBy(cols.entity).agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.sum(F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)).alias("extra"),
    )
    panel_row = per_entity.agg(
        F.sum("n").alias("panel_rows"),
        F.count(cols.entity).alias("panel_entities"),
        F.min("low").cast("bigint").alias("panel_min_value"),
        F.sum(F.when(e.isin(list(sentinels)), F.col("n")).otherwise(0)).alias("panel_sentinels"),
        F.sum("extra").alias("panel_duplicate_keys"),
    )
    return as_long(fact_row).unionByName(as_long(panel_row))


def duplicate_keys(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """(day, entity) keys that occur more than once; must be empty."""
    return (
        panel.groupBy(cols.day, cols.entity)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def entities_per_year(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """Distinct entities of each year (two combined groupings, no exact distinct set)."""
    pairs = panel.select(F.year(cols.day).alias("year"), cols.entity).distinct()
    return pairs.groupBy("year").agg(F.count(cols.entity).alias("entities"))


def busiest_entity(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """The id with most rows, the smallest id on a tie."""
    sizes = panel.groupBy(cols.entity).agg(F.count(F.lit(1)).alias("n_rows"))
    return sizes.orderBy(F.desc("n_rows"), F.asc(cols.entity)).limit(1)


def panel_summary(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """Rows, distinct entities and number of columns of a panel."""
    sizes = panel.groupBy(cols.entity).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(cols.entity).alias("n_entities"),
        F.lit(len(panel.columns)).cast("bigint").alias("n_columns"),
    )


def volume_ranking(panel: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """Mean value per entity, largest first."""
    return (
        panel.groupBy(cols.entity)
        .agg(F.avg(cols.value).alias("mean_value"))
        .orderBy(F.desc("mean_value"), F.asc(cols.entity))
    )
