"""Row-shift features: lags, trailing means, future targets.

Shifts follow rows, not calendar days: a missing day closes up. All windows are
`partitionBy(entity).orderBy(day)`; a panel has one row per (entity, day), so a
partition is never longer than the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidepanel.columns import DEFAULT, PanelCols


def by_day(cols: PanelCols = DEFAULT) -> WindowSpec:
    return Window.partitionBy(cols.entity).orderBy(cols.day)


def whole(cols: PanelCols = DEFAULT) -> WindowSpec:
    """All rows of the entity, in the same order as `by_day` so both share one sort."""
    return by_day(cols).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def lag_columns(lags, cols: PanelCols = DEFAULT) -> dict[str, Column]:
    return {f"lag_{k}": F.lag(cols.value, k).over(by_day(cols)) for k in lags}


def roll_columns(windows, cols: PanelCols = DEFAULT, full_only: bool = True) -> dict[str, Column]:
    """Mean of the w rows before the current one.

    NULL unless all w exist and are known. With `full_only` off the check is
    left to callers that drop the warm-up rows themselves and have no NULLs,
    which halves the work per frame.
    """
    out = {}
    for w in windows:
        frame = by_day(cols).rowsBetween(-w, -1)
        mean = F.sum(cols.value).over(frame) / F.lit(float(w))
        if full_only:
            mean = F.when(F.count(cols.value).over(frame) == w, mean)
        out[f"roll_{w}"] = mean
    return out


def target_columns(horizon: int, cols: PanelCols = DEFAULT) -> dict[str, Column]:
    return {
        f"target_j{h}": F.lead(cols.value, h).over(by_day(cols)) for h in range(1, horizon + 1)
    }


def _with_complete(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    if not added:
        return df
    return df.withColumns(added).dropna(subset=list(added))


def add_lags(df: DataFrame, lags=(1, 7, 30), cols: PanelCols = DEFAULT) -> DataFrame:
    """lag_k = value k rows earlier; rows with any missing lag are dropped."""
    return _with_complete(df, lag_columns(lags, cols))


def add_rolling(df: DataFrame, windows=(7, 30), cols: PanelCols = DEFAULT) -> DataFrame:
    """roll_w = mean of the w preceding rows; rows with an incomplete window are dropped."""
    return _with_complete(df, roll_columns(windows, cols))


def add_targets(df: DataFrame, horizon: int = 7, cols: PanelCols = DEFAULT) -> DataFrame:
    """target_jh = value h rows later; the incomplete tail is dropped."""
    return _with_complete(df, target_columns(horizon, cols))


def shift_features(
    df: DataFrame,
    lags=(1, 7, 30),
    rolls=(),
    horizon: int = 7,
    require_target: bool = True,
    extra: dict[str, Column] | None = None,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """Lags, rolls and targets in one window pass.

    Equals lags, then rolls on the remaining rows, then targets: the lag step
    drops max(lags) head rows and the roll step max(rolls) more, so the head
    loses the sum of both. `extra` takes further window columns over `by_day`
    or `whole`. Values must not be NULL, as in any panel from `daily_panel`.
    """
    lags, rolls = tuple(lags or ()), tuple(rolls or ())
    warm_up = max(lags, default=0) + max(rolls, default=0)
    added = {
        **lag_columns(lags, cols),
        **roll_columns(rolls, cols, full_only=False),
        **target_columns(horizon, cols),
        **(extra or {}),
        "_row": F.row_number().over(by_day(cols)),
    }
    out = df.withColumns(added).filter(F.col("_row") > warm_up).drop("_row")
    if require_target and horizon:
        out = out.filter(F.col(f"target_j{horizon}").isNotNull())
    return out


def calendar_spaced(df: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """Panel with a NULL-valued row for every missing day between an entity's ends.

    An option for shifts by calendar day; the gap rows are generated from each
    entity's own first and last day.
    """
    span = df.groupBy(cols.entity).agg(F.min(cols.day).alias("a"), F.max(cols.day).alias("b"))
    days = span.select(cols.entity, F.explode(F.sequence("a", "b")).alias(cols.day))
    return days.join(df, [cols.entity, cols.day], "left")
