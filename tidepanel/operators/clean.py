"""Cleaning: column names, typed cells, dropped ids, labels, time filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.functions import text


def harmonise_columns(df: DataFrame, renames: dict[str, str] = config.ID_COLUMN_NAMES) -> DataFrame:
    """Rename the columns that exist; absent keys are ignored."""
    return df.withColumnsRenamed(renames)


def keep_columns(df: DataFrame, keep: list[str] = config.KEPT_COLUMNS) -> DataFrame:
    """The existing columns of `keep`, in its order."""
    return df.select(*[c for c in keep if c in df.columns])


def clean_types(
    df: DataFrame, day="JOUR", entity="ID_LIEU", count="NB_VALD", strict: bool = True
) -> DataFrame:
    """Typed day, id and count from text cells (already typed counts pass through)."""
    is_text = dict(df.dtypes)[count] == "string"
    parsed = text.parse_count(F.col(count)) if is_text else F.col(count).cast("double")
    return df.withColumns(
        {
            day: text.parse_day(F.col(day), strict=strict),
            entity: text.parse_id(F.col(entity), strict=strict),
            count: parsed,
        }
    )


def concat_facts(frames: list[DataFrame], strict: bool = True) -> DataFrame:
    """One typed fact table from raw frames that carry ANNEE and PERIODE."""
    keep = config.KEPT_COLUMNS + ["ANNEE", "PERIODE"]
    cleaned = [
        clean_types(keep_columns(harmonise_columns(f), keep), strict=strict) for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cleaned)


def drop_ids(df: DataFrame, ids: list[int], entity: str = "ID_LIEU") -> DataFrame:
    """Drop rows with a listed id; rows without id stay."""
    return df.filter(~F.coalesce(F.col(entity).isin(list(ids)), F.lit(False)))


def drop_ids_in(df: DataFrame, ids: DataFrame, entity: str = "ID_LIEU") -> DataFrame:
    """Drop rows whose id occurs in a table of ids of any size."""
    return df.join(ids.select(entity), entity, "left_anti")


def drop_unusable(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def normalize_labels(df: DataFrame, label: str = "LIBELLE_ARRET") -> DataFrame:
    """Title-cased labels; NULL stays NULL rather than becoming text."""
    return df.withColumn(label, text.title_label(F.col(label)))


def label_keys(df: DataFrame, label: str = "LIBELLE_ARRET") -> DataFrame:
    """(label, key) for every distinct label, so the UDF sees each label once."""
    return df.select(label).distinct().withColumn("key", text.label_key(F.col(label)))


def from_day(df: DataFrame, start: str, day: str = "JOUR") -> DataFrame:
    return df.filter(F.col(day) >= F.lit(start).cast("date"))


def exclude_window(df: DataFrame, window: tuple[str, str] | None, day: str = "JOUR") -> DataFrame:
    """Drop days d with start <= d < end; later row shifts then bridge the hole."""
    if window is None:
        return df
    start, end = (F.lit(x).cast("date") for x in window)
    return df.filter((F.col(day) < start) | (F.col(day) >= end))


def min_rows_needed(lags=(), rolls=(), horizon: int = 0) -> int:
    """An entity must have more rows than this to enter a model."""
    return max([*(lags or ()), *(rolls or ()), 1]) + horizon + 1


def with_min_history(df: DataFrame, more_than: int, group: str = "ID_LIEU") -> DataFrame:
    """Rows of groups having more than `more_than` rows.

    Counting is a map-side combined aggregate and the semi join is on the
    group, so a hot group is split by adaptive execution instead of being
    windowed in one task.
    """
    big = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > more_than)
    return df.join(big.select(group), group, "left_semi")


def entity_labels(df: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """One label per id: the first alphabetically."""
    return df.groupBy(cols.entity).agg(F.min(cols.label).alias(cols.label))


def first_labels(df: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """One label per id: the earliest non-null one, the smallest on a tie."""
    known = df.filter(F.col(cols.label).isNotNull())
    return known.groupBy(cols.entity).agg(
        F.min_by(cols.label, F.struct(cols.day, cols.label)).alias(cols.label)
    )


def distinct_entities(df: DataFrame, entity: str = "ID_LIEU") -> DataFrame:
    return df.select(entity).distinct().orderBy(entity)

