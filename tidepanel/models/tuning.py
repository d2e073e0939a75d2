"""Walk-forward tuning of the pooled model over one stored matrix.

Every fold has levels and profiles of its own, from the days before its first
validation day, so no fold sees what its validation days would tell. They are
aggregated for all folds in one pass over the panel. The matrix is assembled
once, with a fold and a role, and written in a folder per fold; each fit reads
its own. The scores of all configurations and folds come from one aggregate over
the predictions of the validation rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.functions.quantiles import exact_quantiles
from tidepanel.models import elastic_net, linear
from tidepanel.models.pooled import assemble, sample_configs, tree_params
from tidepanel.operators import clean, features, matrix, metrics, splits
from tidepanel.session import dealt_out, materialize, scratch_path, tasks_for

TRAIN, VALID = "train", "validation"


def fold_profiles(
    panel: DataFrame, day_table: DataFrame, firsts: list, profiles: bool = True, cols: PanelCols = DEFAULT
) -> DataFrame:
    """(entity, folds): per fold the level and profile of the days before its first validation day.

    One aggregate over the panel for all folds. A fold where the entity has no
    positive level, or an undefined profile, is left out.
    """
    flags = F.broadcast(day_table.select(cols.day, "IS_WEEKEND", "IS_VACANCES"))
    rows = panel.select(cols.entity, cols.day, cols.value).join(flags, cols.day, "left")
    wanted = config.PROFILE_COLUMNS if profiles else []
    aggs = []
    for fold, first in firsts:
        before = F.col(cols.day) < F.lit(first).cast("date")
        measures = features.profile_columns(cols.value, cols.day, keep=before)
        aggs.append(
            F.struct(
                F.lit(fold).alias("fold"), F.avg(F.when(before, F.col(cols.value))).alias("lvl"),
                *[measures[c].alias(c) for c in wanted],
            ).alias(f"fold_{fold}")
        )
    wide = rows.groupBy(cols.entity).agg(*aggs)
    usable = F.filter(
        F.array(*[f"fold_{fold}" for fold, _ in firsts]),
        lambda f: _all([f["lvl"] > 0, *[f[c].isNotNull() for c in wanted]]),
    )
    return wide.select(cols.entity, usable.alias("folds"))


def _all(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return F.coalesce(out, F.lit(False))


def fold_matrix(
    panel: DataFrame, day_table: DataFrame, test_cutoff, n_folds: int = 3, min_train_frac: float = 0.5,
    horizon: int = config.HORIZON, lags=config.LAGS, rolls=config.ROLLS, add_profiles: bool = True,
    exclude_window=None, cols: PanelCols = DEFAULT,
) -> tuple[DataFrame, list[tuple]]:
    """(rows, bounds): each fold's training and validation rows, normalised by the fold's own levels.

    Rows have `fold`, `role`, the features, absolute targets and `lvl`. `bounds`
    are the (fold, first, last) validation days, as many as there are folds.
    """
    raw = matrix.pooled_matrix(
        panel, day_table, test_cutoff, horizon, lags, rolls, normalize=False, add_profiles=False,
        exclude_window=exclude_window, cols=cols,
    ).drop("lvl")
    raw = materialize(raw.filter(F.col(cols.day) < F.lit(test_cutoff).cast("date")), "unscaled", "zstd")
    found = splits.walk_forward_folds(raw, test_cutoff, n_folds, min_train_frac, cols.day).collect()
    bounds = sorted((r["fold"], r["val_first"], r["val_last"]) for r in found)
    kept = clean.exclude_window(panel, exclude_window, cols.day)
    own = fold_profiles(kept, day_table, [(k, first) for k, first, _ in bounds], add_profiles, cols)
    day = F.col(cols.day)
    edges = F.create_map(*[
        x for k, first, last in bounds
        for x in (F.lit(k), F.struct(F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")))
    ]) if bounds else F.create_map().cast("map<int,struct<first:date,last:date>>")
    # Rows are repeated for each fold and then sorted to be stored by fold, so tasks are made for their number.
    tasks = tasks_for(raw.sparkSession, raw.count() * max(1, len(bounds)))
    rows = raw.repartition(tasks, cols.entity).join(own, cols.entity).withColumn("f", F.explode("folds")).drop("folds")
    rows = rows.withColumn("edge", edges[F.col("f.fold")]).filter(day <= F.col("edge.last"))
    scaled = {c: F.col(c) / F.col("f.lvl") for c in [*[f"lag_{k}" for k in lags], *[f"roll_{w}" for w in rolls]]}
    extra = {c: F.col(f"f.{c}") for c in (config.PROFILE_COLUMNS if add_profiles else [])}
    role = F.when(day < F.col("edge.first"), TRAIN).otherwise(VALID)
    rows = rows.withColumns({**scaled, **extra, "lvl": F.col("f.lvl"), "fold": F.col("f.fold"), "role": role})
    names = matrix.pooled_feature_names(lags, rolls, add_profiles)
    return rows.select("fold", "role", cols.entity, cols.day, *names, *matrix.target_names(horizon), "lvl"), bounds


def store_assembled(rows: DataFrame, names: list[str], horizon: int, cols: PanelCols = DEFAULT) -> DataFrame:
    """Rows with one vector of features and the targets as ratios, written once, a folder per fold and role."""
    targets = matrix.target_names(horizon)
    ratios = {f"_y{h}": F.col(t) / F.col("lvl") for h, t in enumerate(targets, 1)}
    out = assemble(rows, names).withColumns(ratios).select(
        "fold", "role", cols.entity, cols.day, "features", *targets, *ratios, "lvl"
    )
    path = scratch_path(rows.sparkSession, "folds")
    out.write.option("compression", "zstd").partitionBy("fold", "role").parquet(path)
    return rows.sparkSession.read.parquet(path)


#: (configuration number, fold, ...) and pred_j1.. of the validation rows of some folds.
Learner = Callable[[DataFrame, list[dict], list[int], int, int], DataFrame]


def tree_learner(stored: DataFrame, configs: list[dict], folds: list[int], horizon: int, n_features: int) -> DataFrame:
    """Boosted trees: one fit per configuration, fold and horizon, each reading its fold's training rows."""
    parts = []
    for cfg in configs:
        for fold in folds:
            mine = stored.filter(F.col("fold") == fold)
            train = dealt_out(mine.filter(F.col("role") == TRAIN))
            settings = tree_params(cfg, n_features, train.count() if cfg.get("gamma") else 0)
            models = [
                GBTRegressor(featuresCol="features", labelCol=f"_y{h}", predictionCol=f"pred_j{h}", seed=config.MODEL_SEED, **settings)
                .fit(train)
                for h in range(1, horizon + 1)
            ]
            out = mine.filter(F.col("role") == VALID).withColumn("config", F.lit(cfg["config"]))
            for model in models:
                out = model.transform(out)
            parts.append(out.withColumns({f"pred_j{h}": F.col(f"pred_j{h}") * F.col("lvl") for h in range(1, horizon + 1)}))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def net_learner(stored: DataFrame, configs: list[dict], folds: list[int], horizon: int, n_features: int) -> DataFrame:
    """Elastic nets: all configurations of all folds from one pass of moments and one of predictions."""
    names = [f"_x{i}" for i in range(n_features)]
    values = vector_to_array("features")
    rows = stored.filter(F.col("fold").isin(folds)).withColumns({n: values[i] for i, n in enumerate(names)})
    ratios = [f"_y{h}" for h in range(1, horizon + 1)]
    moments = linear.group_moments(rows.filter(F.col("role") == TRAIN), ["fold"], names, ratios)
    grid = [(float(c["penalty"]), float(c.get("l1_ratio", 0.0))) for c in configs]
    # As many rows as folds.
    models = moments.select("fold", elastic_net.solve_net(F.col("moments"), n_features, horizon, grid).alias("grid"))
    valid = rows.filter(F.col("role") == VALID).join(F.broadcast(models), "fold")
    numbers = F.array(*[F.struct(F.lit(c["config"]).alias("config"), F.lit(g).alias("g")) for g, c in enumerate(configs)])
    each = valid.select("*", F.inline(numbers))
    preds = {
        f"pred_j{h}": linear.linear_prediction(names, F.col("grid")[F.col("g")][h - 1]) * F.col("lvl")
        for h in range(1, horizon + 1)
    }
    return each.withColumns(preds).drop("grid", "g", *names)


def fold_scores(predictions: DataFrame, horizon: int, cols: PanelCols = DEFAULT) -> DataFrame:
    """(config, fold, score): the exact median over entities of the percentage error, from one aggregate."""
    unit = F.struct("config", "fold", cols.entity)
    long = metrics.horizon_metrics(predictions.withColumn("unit", unit), "unit", horizon)
    per = metrics.entity_metrics(long, "unit", horizon).select("unit.*", "mae_pct")
    per = materialize(per, "fold-errors")
    pairs = sorted((r["config"], r["fold"]) for r in per.select("config", "fold").distinct().collect())
    wide = per.groupBy(cols.entity).agg(*[
        F.max(F.when((F.col("config") == c) & (F.col("fold") == k), F.col("mae_pct"))).alias(f"{c}_{k}") for c, k in pairs
    ])
    found = exact_quantiles(wide, [f"{c}_{k}" for c, k in pairs], [0.5])
    name = F.split("name", "_")
    return found.select(name[0].cast("int").alias("config"), name[1].cast("int").alias("fold"), F.col("quantile").alias("score"))


def tune(
    panel: DataFrame, day_table: DataFrame, test_cutoff, grid: dict[str, list] = config.POOLED_GRID, n_iter: int = 30,
    learner: Learner = tree_learner,
    n_folds: int = 3, min_train_frac: float = 0.5, keep: float = 1.0, horizon: int = config.HORIZON, lags=config.LAGS,
    rolls=config.ROLLS, add_profiles: bool = True, exclude_window=None, names: list[str] | None = None,
    seed: int = config.SAMPLE_SEED, cols: PanelCols = DEFAULT,
) -> DataFrame:
    """(config, params, fold, score) of random configurations, days from `test_cutoff` on left out.

    `names` are the features (all of the matrix). With `keep` below one, folds
    are scored one after another and after each only that share of the
    configurations, those with the lowest mean score so far, goes on to the next.
    """
    spark = panel.sparkSession
    rows, bounds = fold_matrix(
        panel, day_table, test_cutoff, n_folds, min_train_frac, horizon, lags, rolls, add_profiles, exclude_window, cols
    )
    names = matrix.pooled_feature_names(lags, rolls, add_profiles) if names is None else list(names)
    stored = store_assembled(rows, names, horizon, cols)
    alive = [{**c, "config": i} for i, c in enumerate(sample_configs(grid, n_iter, seed))]
    params = {c["config"]: str(sorted((k, v) for k, v in c.items() if k != "config")) for c in alive}
    folds = [k for k, _, _ in bounds]
    rungs = [folds] if keep >= 1 else [[k] for k in folds]
    scores: list[tuple] = []
    for rung in rungs:
        if not rung:
            break
        predictions = learner(stored, alive, rung, horizon, len(names))
        scores += [
            (r["config"], params[r["config"]], r["fold"], r["score"]) for r in fold_scores(predictions, horizon, cols).collect()
        ]
        if keep < 1:
            mean = {c["config"]: [s for n, _, _, s in scores if n == c["config"]] for c in alive}
            order = sorted(alive, key=lambda c: (sum(mean[c["config"]]) / max(1, len(mean[c["config"]])), c["config"]))
            alive = order[: max(1, round(keep * len(alive)))]
    return spark.createDataFrame(scores, "config int, params string, fold int, score double")


def best_of(scores: DataFrame) -> DataFrame:
    """(config, params, score, fold_scores): lowest mean score among the configurations scored on all folds."""
    means = scores.groupBy("config", "params").agg(
        F.avg("score").alias("score"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "score"))), lambda x: x["score"]).alias("fold_scores"),
    )
    most = means.agg(F.max(F.size("fold_scores"))).first()[0]
    return means.filter(F.size("fold_scores") == (most or 0)).orderBy("score", "config").limit(1)
