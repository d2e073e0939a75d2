"""Whole jobs made of the operators: load, train, evaluate, serve."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.models import elastic_net, linear, pooled
from tidepanel.operators import (
    baselines, clean, entities, features, joins, matrix, metrics, panel as panels, splits,
)
from tidepanel.session import materialize
from tidepanel.sources import files
from tidepanel.sources.calendar import load_calendar
from tidepanel.sources.weather import load_weather


def load_validations(
    spark: SparkSession,
    data_dir: str,
    entries=tuple(config.FILE_MANIFEST),
    aggregate: bool = True,
    strict_decoding: bool = False,
) -> DataFrame:
    """Cleaned facts, or with `aggregate` the resolved daily panel.

    The aggregated panel is written once, because entity resolution reads it
    several times.
    """
    paths = [files.build_path(data_dir, y, p, ext) for y, p, ext in entries]
    formats = files.require_formats(
        files.detect_formats(spark, paths, strict_decoding=strict_decoding)
    )
    facts = clean.concat_facts(files.load_source(spark, formats))
    if not aggregate:
        return facts
    first_by = F.struct("ANNEE", "PERIODE", "LIBELLE_ARRET")
    return clean_panel(panels.daily_panel(facts, first_by=first_by))


def clean_panel(
    panel: DataFrame,
    sentinels=tuple(config.SENTINEL_IDS),
    excluded=tuple(config.EXCLUDED_IDS),
    cols: PanelCols = DEFAULT,
    **resolution,
) -> DataFrame:
    """Dropped ids, tidy labels, resolved entities and hubs."""
    out = clean.drop_ids(panel, [*sentinels, *excluded], cols.entity)
    out = materialize(clean.normalize_labels(out, cols.label), "panel")
    return entities.merge_entities(out, cols=cols, **resolution)


def get_data(
    spark: SparkSession,
    data_dir: str,
    train_from: str = config.TRAIN_FROM,
    school_holidays: DataFrame | None = None,
    entries=tuple(config.FILE_MANIFEST),
    weather_files=None,
) -> DataFrame:
    """Resolved panel joined with weather and calendar, from a day on.

    Entity resolution sees the full history; the day filter then reaches both
    sides of the joins.
    """
    panel = load_validations(spark, data_dir, entries)
    weather = joins.broadcast_if_small(load_weather(spark, data_dir, weather_files))
    calendar = F.broadcast(load_calendar(spark, school_holidays=school_holidays))
    return clean.from_day(joins.join_by_day(panel, weather, calendar), train_from)


def pooled_inputs(
    panel: DataFrame, weather: DataFrame, calendar: DataFrame, cols: PanelCols = DEFAULT
) -> DataFrame:
    """The day table of `matrix.pooled_matrix`; weather weighs by the panel's rows."""
    medians = features.weather_medians(panel, weather, cols)
    return features.day_features(calendar, weather, medians, cols.day)


def train_model(
    panel: DataFrame,
    day_table: DataFrame,
    params: dict = config.POOLED_PARAMS,
    horizon: int = config.HORIZON,
    lags=config.LAGS,
    rolls=config.ROLLS,
    exclude_window=config.EXCLUDE_WINDOW,
    cutoff=config.DEPLOY_CUTOFF,
    cols: PanelCols = DEFAULT,
) -> pooled.PooledBundle:
    """Pooled model for deployment; without a cutoff it learns from all days."""
    level_cutoff = cutoff
    if level_cutoff is None:
        last = panel.agg(F.max(cols.day)).first()[0]
        level_cutoff = panel.sparkSession.range(1).select(
            F.date_add(F.lit(last), 1)
        ).first()[0]
    rows = matrix.pooled_matrix(
        panel, day_table, level_cutoff, horizon, lags, rolls, exclude_window=exclude_window, cols=cols
    )
    rows = materialize(rows, "pooled", "zstd")
    kept = clean.exclude_window(panel, exclude_window, cols.day)
    flagged = kept.join(
        F.broadcast(day_table.select(cols.day, "IS_WEEKEND", "IS_VACANCES")), cols.day, "left"
    )
    levels, profiles = features.levels_profiles(flagged, level_cutoff, cols)
    names = matrix.pooled_feature_names(lags, rolls)
    return pooled.train_pooled(
        rows, names, params, horizon, levels, profiles, cutoff, lags, rolls, cols=cols
    )


def evaluate_per_entity(
    bundle: pooled.PooledBundle, rows: DataFrame, labels: DataFrame, cutoff, cols: PanelCols = DEFAULT
) -> DataFrame:
    """Held-out errors of a stored model per entity, best first, rounded for reports."""
    horizon = bundle.meta["horizon"]
    test = clean.from_day(rows, cutoff, cols.day)
    scored = pooled.predict_horizons(test, bundle.models, bundle.feature_names)
    per = metrics.per_entity_metrics(scored, cols.entity, horizon)
    report = per.join(labels, cols.entity, "left").select(
        F.col(cols.entity).alias("station_id"),
        F.coalesce(cols.label, F.lit("")).alias("libelle"),
        "n_test",
        F.bround("mae", 1).alias("mae"),
        F.bround("mae_pct", 2).alias("mae_pct"),
        F.bround("r2", 4).alias("r2"),
        *[F.bround(f"mae_pct_j{h}", 2).alias(f"mae_pct_j{h}") for h in range(1, horizon + 1)],
    )
    return metrics.ranked(report, "mae_pct", "station_id")


def evaluate_by_share(
    panel: DataFrame,
    day_table: DataFrame,
    params: dict = config.POOLED_PARAMS,
    test_size: float = config.TEST_SIZE,
    horizon: int = config.HORIZON,
    lags=config.LAGS,
    rolls=config.ROLLS,
    normalize: bool = True,
    add_profiles: bool = True,
    exclude_window=config.EXCLUDE_WINDOW,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """Errors per entity on the last `test_size` of the matrix's days, levels and profiles from the days before.

    The days of the matrix don't depend on the cutoff, so a bare matrix gives
    them first. Without `normalize` features and targets stay absolute, without
    `add_profiles` the profiles are left out.
    """
    last = panel.agg(F.date_add(F.max(cols.day), 1)).first()[0]
    bare = matrix.pooled_matrix(
        panel, day_table, last, horizon, lags, rolls, normalize=False, add_profiles=False,
        exclude_window=exclude_window, cols=cols,
    )
    cutoff = splits.day_cutoff(bare.select(cols.day), test_size, cols.day).first()[0]
    rows = matrix.pooled_matrix(
        panel, day_table, cutoff, horizon, lags, rolls, normalize, add_profiles, exclude_window, cols=cols
    )
    names = matrix.pooled_feature_names(lags, rolls, add_profiles)
    rows = materialize(rows, "pooled", "zstd")
    return pooled.evaluate_pooled(rows, names, params, horizon, cutoff, by_level=normalize, cols=cols)


def evaluate_against_baseline(
    model_metrics: DataFrame, panel: DataFrame, horizon: int, lags=(), rolls=(), cols: PanelCols = DEFAULT
) -> DataFrame:
    """Medians of a model next to those of the weekly naive forecast."""
    guard = clean.min_rows_needed(lags, rolls, horizon)
    naive = baselines.weekly_naive_metrics(panel, horizon, min_history=guard, cols=cols)
    base = baselines.baseline_metrics(naive, cols.entity, horizon)
    return metrics.compare(
        metrics.aggregate_metrics(model_metrics, horizon), metrics.aggregate_metrics(base, horizon), horizon
    )


def train_per_group(
    rows: DataFrame,
    group: str,
    names: list[str],
    horizon: int,
    alpha: float = 1.0,
    test_size: float = config.TEST_SIZE,
    min_rows: int = config.MIN_GROUP_ROWS,
    log_target: bool = False,
    cols: PanelCols = DEFAULT,
) -> tuple[DataFrame, DataFrame]:
    """(models, metrics) of one linear model per group of enough rows, split by day."""
    targets = matrix.target_names(horizon)
    enough = clean.with_min_history(rows, min_rows - 1, group)
    cutoffs = splits.group_day_cutoffs(enough, group, test_size, cols.day)
    split = enough.join(cutoffs, group)
    train = split.filter(F.col(cols.day) < F.col("cutoff"))
    test = split.filter(F.col(cols.day) >= F.col("cutoff"))
    fitted = linear.fit_group_ridge(
        features.log_target(train, targets) if log_target else train, group, names, targets, alpha
    )
    scored = linear.predict_group_linear(test, fitted, group, names, horizon)
    if log_target:
        scored = features.unlog(scored, [f"pred_j{h}" for h in range(1, horizon + 1)])
    return fitted, metrics.per_entity_metrics(scored, group, horizon)


def search_per_group(
    rows: DataFrame,
    group: str,
    names: list[str],
    horizon: int,
    alphas: list[float],
    n_splits: int = 3,
    test_size: float = config.TEST_SIZE,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """Best penalty of every group by time-ordered cross-validation on its training days."""
    targets = matrix.target_names(horizon)
    rows = materialize(rows.select(*dict.fromkeys([group, cols.entity, cols.day, *names, *targets])), "search")
    large = splits.large_groups(rows, group)
    split = splits.with_group_cutoff(rows, group, test_size, cols.day, large)
    train = split.filter(F.col(cols.day) < F.col("cutoff")).drop("cutoff")
    tie = cols.entity if group != cols.entity else cols.day
    indexed = splits.ordered_index(train, group, cols.day, tie, large=large)
    blocks = splits.ts_cv_blocks(indexed, n_splits).select(group, "block", *names, *targets)
    blocks = materialize(blocks, "blocks")
    return linear.ridge_search(blocks, group, names, targets, alphas, n_splits)


def search_refit(
    rows: DataFrame,
    group: str,
    names: list[str],
    horizon: int,
    penalties: list[float],
    ratios: list[float] = (0.0,),
    n_splits: int = 3,
    test_size: float = config.TEST_SIZE,
    cols: PanelCols = DEFAULT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(choices, models, errors): search on each group's training days, refit, held-out errors.

    Errors are long: the group, h from 1 to `horizon` and h 0 for the mean over
    all horizons, with n, mae, mae_pct and r2. Split rows are written once and
    read by the search, the refit and the errors.
    """
    targets = matrix.target_names(horizon)
    narrow = materialize(rows.select(*dict.fromkeys([group, cols.entity, cols.day, *names, *targets])), "rows")
    large = splits.large_groups(narrow, group)
    split = materialize(splits.with_group_cutoff(narrow, group, test_size, cols.day, large), "search")
    train = split.filter(F.col(cols.day) < F.col("cutoff")).drop("cutoff")
    tie = cols.entity if group != cols.entity else cols.day
    blocks = splits.ts_cv_blocks(splits.ordered_index(train, group, cols.day, tie, large=large), n_splits)
    blocks = materialize(blocks.select(group, "block", *names, *targets), "blocks")
    grid = elastic_net.net_grid(penalties, ratios)
    choices, models = elastic_net.net_search(blocks, group, names, targets, grid, n_splits)
    models = materialize(models, "models")
    test = split.filter(F.col(cols.day) >= F.col("cutoff"))
    long = metrics.horizon_metrics(linear.predict_group_linear(test, models, group, names, horizon), group, horizon)
    long = long.select(group, "h", "n", "mae", "true_mean", "mae_pct", "r2")
    total = long.groupBy(group).agg(
        F.max("n").alias("n"), F.avg("mae").alias("mae"), F.avg("true_mean").alias("true_mean"), F.avg("r2").alias("r2")
    ).withColumn("h", F.lit(0)).withColumn("mae_pct", F.col("mae") / F.nullif(F.col("true_mean"), F.lit(0.0)) * 100)
    return choices, models, long.unionByName(total)


def consensus_choices(choices: DataFrame, group: str) -> DataFrame:
    """(name, value): the median over groups of each parameter that a search chose."""
    named = [F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("penalty", "l1_ratio")]
    return metrics.consensus_params(
        choices.select(group, F.inline(F.array(*named))), config.WHOLE_NUMBER_PARAMS
    )


def score_group(
    rows: DataFrame, models: DataFrame, group: str, names: list[str], horizon: int, cols: PanelCols = DEFAULT
) -> DataFrame:
    """Errors of stored group models over all their rows, and the latest forecast."""
    scored = linear.predict_group_linear(rows, models, group, names, horizon)
    last = scored.groupBy(group).agg(
        F.max(cols.day).alias("last_day"),
        F.max_by(f"pred_j{horizon}", F.struct(cols.day, cols.entity)).alias("last_prediction"),
    )
    return metrics.per_entity_metrics(scored, group, horizon).join(last, group)


