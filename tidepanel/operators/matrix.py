"""Model matrices: per-entity preparation and the pooled, level-normalised matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.operators import clean, features, windows


def target_names(horizon: int) -> list[str]:
    return [f"target_j{h}" for h in range(1, horizon + 1)]


def feature_names(df: DataFrame, keep_id: bool = False, cols: PanelCols = DEFAULT) -> list[str]:
    """Every column that is no id, day, label, value, target or level, in order."""
    skip = {cols.day, cols.label, cols.value, "lvl"}
    if not keep_id:
        skip.add(cols.entity)
    return [c for c in df.columns if c not in skip and not c.startswith("target_j")]


def pooled_feature_names(lags=config.LAGS, rolls=config.ROLLS, profiles: bool = True) -> list[str]:
    """Feature order of the pooled matrix."""
    return (
        config.WEATHER_COLUMNS
        + config.CALENDAR_COLUMNS
        + config.TIME_COLUMNS
        + config.DERIVED_WEATHER_COLUMNS
        + [f"lag_{k}" for k in lags]
        + [f"roll_{w}" for w in rolls]
        + (config.PROFILE_COLUMNS if profiles else [])
    )


def prepare_matrix(
    df: DataFrame,
    lags=config.EVAL_LAGS,
    rolls=(),
    horizon: int = config.HORIZON,
    keep_id: bool = False,
    clusters: list[int] | str | None = None,
    scale: bool = False,
    exclude_window=None,
    cols: PanelCols = DEFAULT,
) -> tuple[DataFrame, list[str], list[str]]:
    """Matrix rows of a featured panel with the names of its features and targets.

    Excluded days go before the shifts, so lags bridge the hole. `clusters`
    lists the values to one-hot, "all" takes all that occur.
    """
    out = clean.exclude_window(df, exclude_window, cols.day)
    out = windows.shift_features(out, lags, rolls, horizon, cols=cols)
    if clusters is not None and "cluster" in out.columns:
        out = features.one_hot(out, None if clusters == "all" else clusters)
    names = feature_names(out, keep_id, cols)
    if scale:
        out = features.robust_scale(out, [c for c in config.SCALED_COLUMNS if c in names])
    return out, names, target_names(horizon)


def pooled_matrix(
    panel: DataFrame,
    day_table: DataFrame,
    level_cutoff,
    horizon: int = config.HORIZON,
    lags=config.LAGS,
    rolls=config.ROLLS,
    normalize: bool = True,
    add_profiles: bool = True,
    exclude_window=None,
    entities: DataFrame | None = None,
    require_target: bool = True,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """All entities in one matrix: features, absolute targets, entity, day and `lvl`.

    One shuffle and one sort on the entity serve lags, rolls, targets, row
    counts, levels and profiles, which are window expressions rather than
    aggregates joined back. Only (entity, day, value) and two flags travel
    through it; `day_table` (features.day_features, as many rows as the calendar
    has days) is joined afterwards by broadcast. Levels and profiles read days
    before `level_cutoff` only. Entities without a positive level, a full
    profile or enough history are left out.
    """
    flags = F.broadcast(day_table.select(cols.day, "IS_WEEKEND", "IS_VACANCES"))
    rows = clean.exclude_window(panel.select(cols.entity, cols.day, cols.value), exclude_window, cols.day)
    if entities is not None:
        rows = rows.join(entities.select(cols.entity), cols.entity, "left_semi")
    rows = rows.join(flags, cols.day, "left")

    whole = windows.whole(cols)
    train = F.col(cols.day) < F.lit(level_cutoff).cast("date")
    extra = {
        "lvl": F.avg(F.when(train, F.col(cols.value))).over(whole),
        "_n": F.count(F.lit(1)).over(whole),
    }
    if add_profiles:
        measures = features.profile_columns(cols.value, cols.day, over=whole, keep=train)
        extra.update({c: measures[c] for c in config.PROFILE_COLUMNS})
        # The dispersion is not a feature, but a missing one drops the entity
        # through cv, which is computed from it.
    shifted = windows.shift_features(rows, lags, rolls, horizon, require_target, extra, cols)
    needed = clean.min_rows_needed(lags, rolls, horizon)
    shifted = shifted.filter((F.col("_n") > needed) & (F.col("lvl") > 0))
    if add_profiles:
        shifted = shifted.dropna(subset=config.PROFILE_COLUMNS)
    if normalize:
        scaled = [f"lag_{k}" for k in lags] + [f"roll_{w}" for w in rolls]
        shifted = features.normalise_by_level(shifted, scaled)

    out = shifted.drop("IS_WEEKEND", "IS_VACANCES").join(F.broadcast(day_table), cols.day, "left")
    flag_columns = {c: F.col(c).cast("int") for c in config.CALENDAR_COLUMNS}
    return out.withColumns(flag_columns).select(
        cols.entity,
        cols.day,
        *pooled_feature_names(lags, rolls, add_profiles),
        *target_names(horizon),
        "lvl",
    )


def serving_features(
    matrix: DataFrame, cutoff=None, days: int = 120, last_day=None, cols: PanelCols = DEFAULT
) -> DataFrame:
    """Rows to serve: days from the cutoff on, or else the last `days` days."""
    if cutoff is not None:
        return clean.from_day(matrix, cutoff, cols.day)
    start = F.date_sub(F.lit(last_day).cast("date"), days)
    return matrix.filter(F.col(cols.day) >= start)
