"""Serving features kept up to date: each new day of an entity appends its lags and trailing means."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.operators import clean, features, matrix


def shift_names(lags=config.LAGS, rolls=config.ROLLS) -> list[str]:
    return [f"lag_{k}" for k in lags] + [f"roll_{w}" for w in rolls]


def _row_schema(id_type: str, lags, rolls, cols: PanelCols) -> str:
    doubles = "".join(f", {c} double" for c in shift_names(lags, rolls))
    return f"`{cols.entity}` {id_type}, `{cols.day}` date, `{cols.value}` double, n long, late boolean{doubles}"


def shifts_stream(panel: DataFrame, lags=config.LAGS, rolls=config.ROLLS, cols: PanelCols = DEFAULT) -> DataFrame:
    """Lags and trailing means of a streaming panel, as `windows.shift_features` has them.

    The state of an entity is its latest values, as many as the longest shift,
    the number of its rows and its last day. `n` counts the entity's rows up to
    this one. Rows of one day in one batch are summed. A row whose day is not
    after the last one can't change rows already served: it comes out marked
    `late`, without features. Rows without id, day or value are left out.
    """
    lags, rolls = tuple(lags or ()), tuple(rolls or ())
    kept = max([*lags, *rolls, 1])
    warm_up = max(lags, default=0) + max(rolls, default=0)
    id_type = panel.schema[cols.entity].dataType.simpleString()
    entity, day, value, names = cols.entity, cols.day, cols.value, shift_names(lags, rolls)
    id_dtype = "int64" if id_type in ("tinyint", "smallint", "int", "bigint") else object

    def by_day(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Days in order as `datetime64[D]`, and the sums of their values, of (days, values) in any order."""
        days = np.concatenate([d for d, _ in parts]).astype("datetime64[D]")
        values = np.concatenate([v for _, v in parts]).astype(float)
        order = np.argsort(days, kind="stable")
        days, values = days[order], values[order]
        if (days[1:] == days[:-1]).any():
            sums = pd.Series(values).groupby(days, sort=True).sum()
            return sums.index.to_numpy().astype("datetime64[D]"), sums.to_numpy()
        return days, values

    def shift(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before, seen, last = state.get if state.exists else ([], 0, None)
        days, values = by_day([(p[day].to_numpy(), p[value].to_numpy()) for p in parts])
        # The days are in order, so the late ones come first.
        n_late = int(np.searchsorted(days, np.datetime64(last), "right")) if last is not None else 0
        fresh = values[n_late:]
        late = np.arange(len(days)) < n_late
        number = seen + 1 + np.arange(-n_late, len(fresh))
        columns = {name: np.full(len(days), np.nan) for name in names}
        if len(fresh):
            series = np.concatenate([np.asarray(before, float), fresh])
            full = ~late & (number > warm_up)  # then all shifts lie inside the series
            place = len(before) + np.flatnonzero(full) - n_late  # of the new rows in the series
            for k in lags:
                columns[f"lag_{k}"][full] = series[place - k]
            for w in rolls:
                sums = np.lib.stride_tricks.sliding_window_view(series, w).sum(axis=1) if len(series) >= w else np.empty(0)
                columns[f"roll_{w}"][full] = sums[place - w] / w
            state.update((series[-kept:].tolist(), seen + len(fresh), days[-1].item()))
        yield pd.DataFrame(
            {
                entity: pd.Series([key[0]] * len(days), dtype=id_dtype), day: days.astype(object), value: values,
                "n": pd.arrays.IntegerArray(number, late) if n_late else number, "late": late, **columns,
            }
        )

    rows = panel.select(entity, day, F.col(value).cast("double").alias(value)).dropna()
    return rows.groupBy(entity).applyInPandasWithState(
        shift, _row_schema(id_type, lags, rolls, cols), "values array<double>, n long, last date",
        "append", GroupStateTimeout.NoTimeout,
    )


def run_serving(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema, lags=config.LAGS, rolls=config.ROLLS,
    exclude_window=None, cols: PanelCols = DEFAULT,
) -> None:
    """Append the features of all panel files not seen before to `target`, as one batch, then stop.

    The sink's log makes a replayed batch appear once.
    """
    panel = clean.exclude_window(spark.readStream.schema(schema).parquet(source), exclude_window, cols.day)
    query = (
        shifts_stream(panel, lags, rolls, cols)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _shifts(spark: SparkSession, target: str, id_type: str, lags, rolls, cols: PanelCols) -> DataFrame:
    return spark.read.schema(_row_schema(id_type, lags, rolls, cols)).parquet(target)


def late_points(
    spark: SparkSession, target: str, id_type: str = "bigint", lags=config.LAGS, rolls=config.ROLLS, cols: PanelCols = DEFAULT
) -> DataFrame:
    """(entity, day, value) of rows that came after a later day of their entity."""
    return _shifts(spark, target, id_type, lags, rolls, cols).filter("late").select(cols.entity, cols.day, cols.value)


def kept_features(
    spark: SparkSession,
    target: str,
    levels: DataFrame,
    profiles: DataFrame,
    day_table: DataFrame,
    horizon: int = config.HORIZON,
    lags=config.LAGS,
    rolls=config.ROLLS,
    since=None,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """Features of the rows streamed so far, as `pooled_matrix` without targets has them.

    `levels` and `profiles` are those that the served model was trained with
    (`features.levels_profiles`), `day_table` is of `features.day_features`. Entities that
    lack either, or enough rows so far, are left out. `since` is the first day
    wanted.
    """
    id_type = levels.schema[cols.entity].dataType.simpleString()
    rows = _shifts(spark, target, id_type, lags, rolls, cols).filter(~F.col("late"))
    needed = clean.min_rows_needed(lags, rolls, horizon)
    entities = rows.groupBy(cols.entity).agg(F.max("n").alias("_n")).filter(F.col("_n") > needed).drop("_n")
    known = (
        entities.join(levels.filter(F.col("lvl") > 0), cols.entity)
        .join(profiles.select(cols.entity, *config.PROFILE_COLUMNS), cols.entity)
    )
    full = rows.filter(F.col("n") > max(lags or (), default=0) + max(rolls or (), default=0))
    if since is not None:
        full = clean.from_day(full, since, cols.day)
    scaled = features.normalise_by_level(full.join(known, cols.entity), shift_names(lags, rolls))
    out = scaled.join(F.broadcast(day_table), cols.day, "left")
    flags = {c: F.col(c).cast("int") for c in config.CALENDAR_COLUMNS}
    return out.withColumns(flags).select(
        cols.entity, cols.day, *matrix.pooled_feature_names(lags, rolls), "lvl"
    )
