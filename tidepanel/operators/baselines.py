"""Naive forecasts that a model has to beat."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.operators import windows
from tidepanel.operators.metrics import horizon_metrics
from tidepanel.operators.splits import cut_index


def weekly_naive(panel: DataFrame, horizon: int = 7, cols: PanelCols = DEFAULT) -> DataFrame:
    """target_jh and pred_jh per row; the forecast is the value 7 - h rows back.

    Only rows with all targets and forecasts remain. A horizon past 7 would
    read the future and is refused. Other columns of the panel pass through.
    """
    if not 1 <= horizon <= 7:
        raise ValueError("the weekly naive forecast needs a horizon of 1 to 7")
    w = windows.by_day(cols)
    preds = {f"pred_j{h}": F.lag(cols.value, 7 - h).over(w) for h in range(1, horizon + 1)}
    targets = windows.target_columns(horizon, cols)
    out = panel.withColumns({**targets, **preds})
    return out.dropna(subset=[f"target_j{horizon}", "pred_j1"])


def test_rows_per_group(
    rows: DataFrame, group: str, test_size: float = 0.2, cols: PanelCols = DEFAULT
) -> DataFrame:
    """Rows from each group's cutoff day on, over the group's own distinct days.

    With the entity as group the rows already lie sorted by (entity, day), one
    per day, so position and count come from the same window and nothing moves.
    Otherwise (group, day) pairs are ranked and joined back on both columns,
    which spreads a hot group over its days.
    """
    if group == cols.entity:
        indexed = rows.withColumns(
            {
                "_i": F.row_number().over(windows.by_day(cols)) - 1,
                "_n": F.count(F.lit(1)).over(windows.whole(cols)),
            }
        )
        return indexed.filter(F.col("_i") >= cut_index(F.col("_n"), test_size)).drop("_i", "_n")
    days = rows.select(group, cols.day).distinct()
    ordered = Window.partitionBy(group).orderBy(cols.day)
    ranked = days.withColumns(
        {
            "_i": F.row_number().over(ordered) - 1,
            "_n": F.count(F.lit(1)).over(Window.partitionBy(group)),
        }
    )
    kept = ranked.filter(F.col("_i") >= cut_index(F.col("_n"), test_size))
    return rows.join(kept.select(group, cols.day), [group, cols.day], "left_semi")


def _guard(panel: DataFrame, more_than: int, group: str, cols: PanelCols) -> DataFrame:
    if group == cols.entity:
        n = F.count(F.lit(1)).over(windows.whole(cols))
        return panel.withColumn("_n", n).filter(F.col("_n") > more_than).drop("_n")
    from tidepanel.operators.clean import with_min_history

    return with_min_history(panel, more_than, group)


def weekly_naive_metrics(
    panel: DataFrame,
    horizon: int = 7,
    test_size: float = 0.2,
    group: str | None = None,
    min_history: int | None = None,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """Long metrics (group, h, n, mae, mae_pct, r2) of the weekly naive forecast.

    Shifts always stay inside one entity; `group` is the grain of the split and
    of the metrics.
    """
    group = group or cols.entity
    if min_history is None:
        min_history = max(config.EVAL_LAGS) + horizon + 1
    keep = [cols.entity, cols.day, cols.value] + ([group] if group != cols.entity else [])
    guarded = _guard(panel.select(*keep), min_history, group, cols)
    rows = weekly_naive(guarded, horizon, cols)
    return horizon_metrics(test_rows_per_group(rows, group, test_size, cols), group, horizon)


def flat_baseline(long: DataFrame, group: str, horizon: int) -> DataFrame:
    """One row per group: mae_jh rounded to 0 places, pct_jh to 1, n_test."""
    aggs = [F.max("n").alias("n_test")]
    for h in range(1, horizon + 1):
        at = F.col("h") == h
        aggs.append(F.bround(F.max(F.when(at, F.col("mae"))), 0).alias(f"mae_j{h}"))
        aggs.append(F.bround(F.max(F.when(at, F.col("mae_pct"))), 1).alias(f"pct_j{h}"))
    return long.groupBy(group).agg(*aggs)


def baseline_metrics(long: DataFrame, group: str, horizon: int) -> DataFrame:
    """Baseline in the shape of model metrics: rounded mae_pct_jh, r2 NULL."""
    aggs = [F.avg("mae").alias("_mae"), F.avg("true_mean").alias("_mean")]
    for h in range(1, horizon + 1):
        pct = F.max(F.when(F.col("h") == h, F.col("mae_pct")))
        aggs.append(F.bround(pct, 1).alias(f"mae_pct_j{h}"))
    out = long.groupBy(group).agg(*aggs)
    return out.select(
        group,
        (F.col("_mae") / F.nullif(F.col("_mean"), F.lit(0.0)) * 100).alias("mae_pct"),
        F.lit(None).cast("double").alias("r2"),
        *[f"mae_pct_j{h}" for h in range(1, horizon + 1)],
    )


def mean_and_persistence(
    panel: DataFrame, cutoff, lag: int = 7, cols: PanelCols = DEFAULT
) -> DataFrame:
    """Next-row metrics per entity of two constant-effort forecasts.

    `mean` predicts the entity's training mean, `persistence` the value `lag`
    rows before today. Long table (entity, method, n, mae, mae_pct, r2).
    """
    w, whole = windows.by_day(cols), windows.whole(cols)
    train = F.col(cols.day) < F.lit(cutoff).cast("date")
    rows = panel.select(cols.entity, cols.day, cols.value).withColumns(
        {
            "target_j1": F.lead(cols.value, 1).over(w),
            "_mean": F.avg(F.when(train, F.col(cols.value))).over(whole),
            "_lag": F.lag(cols.value, lag).over(w),
        }
    )
    test = rows.filter(~train).dropna(subset=["target_j1", "_mean", "_lag"])
    # Both forecasts as horizons 1 and 2 of the same target: one aggregate.
    both = test.select(
        cols.entity,
        "target_j1",
        F.col("target_j1").alias("target_j2"),
        F.col("_mean").alias("pred_j1"),
        F.col("_lag").alias("pred_j2"),
    )
    long = horizon_metrics(both, cols.entity, 2)
    return long.select(
        cols.entity,
        F.when(F.col("h") == 1, "mean").otherwise("persistence").alias("method"),
        "n",
        "mae",
        "mae_pct",
        "r2",
    )
