"""Joins of a panel with day-grain and entity-grain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A table of at most this many narrow rows (a few MB) is shipped to every executor.
BROADCAST_ROWS = 100_000


def broadcast_if_small(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when a bounded count shows the table is small.

    Past the bound the table is returned as it is and Spark picks a shuffle
    join. The count stops after `max_rows` + 1 rows; the data itself is not cut.
    """
    if dim.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(dim)
    return dim


def join_by_day(panel: DataFrame, *dims: DataFrame, day: str = "JOUR") -> DataFrame:
    """Left-join one-row-per-day tables; the day's row repeats for every entity."""
    for dim in dims:
        panel = panel.join(dim, day, "left")
    return panel


def lookup_points(
    requests: DataFrame, features: DataFrame, keys: list[str], strict: bool = False
) -> DataFrame:
    """Features of the requested (entity, day) points.

    In strict mode a point without features is an error, as for a served
    request; otherwise unmatched points are simply absent (see `unmatched_points`).
    """
    if not strict:
        return requests.join(features, keys)
    marked = features.withColumn("_found", F.lit(True))
    joined = requests.join(marked, keys, "left")
    point = F.concat_ws(" / ", *[F.col(k).cast("string") for k in keys])
    complain = F.raise_error(F.concat(F.lit("no features for "), point)).cast("boolean")
    return joined.filter(F.coalesce(F.col("_found"), complain)).drop("_found")


def unmatched_points(requests: DataFrame, features: DataFrame, keys: list[str]) -> DataFrame:
    """Requested points that have no features."""
    return requests.join(features.select(*keys), keys, "left_anti")
