"""Elastic nets, searches with refit, walk-forward tuning, and the pieces they share."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel import session
from tidepanel.columns import PanelCols
from tidepanel.functions.quantiles import exact_quantiles
from tidepanel.models import elastic_net, linear, tuning
from tidepanel.operators import features, metrics, panel, splits
from tidepanel.plans import workflows
from tidepanel.session import dealt_out, materialize, tasks_for

C = PanelCols("e", "d", "v", "l")


def moments_of(x, y):
    z = np.column_stack([np.ones(len(x)), x, y])
    return z.T @ z


def test_net_meets_its_optimality_conditions():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 6))
    x[:, 5] = 4.0  # no spread
    y = np.column_stack([x[:, 0] * 2 - x[:, 1] + rng.standard_normal(300), rng.standard_normal(300)])
    grid = elastic_net.net_grid([0.3, 0.01, 0.1], [1.0, 0.5, 0.0])
    assert grid[:3] == [(0.3, 1.0), (0.1, 1.0), (0.01, 1.0)]
    path = elastic_net.net_path(moments_of(x, y).ravel(), 6, 2, grid)
    z = (x[:, :5] - x[:, :5].mean(0)) / x[:, :5].std(0)
    for (penalty, ratio), fit in zip(grid, path):
        for t in range(2):
            u = (y[:, t] - y[:, t].mean()) / y[:, t].std()
            w = np.array(fit[t][1:6]) * x[:, :5].std(0) / y[:, t].std()
            assert fit[t][6] == 0
            slope = z.T @ (u - z @ w) / len(z) - penalty * (1 - ratio) * w
            used = np.abs(w) > 1e-12
            assert np.allclose(slope[used], penalty * ratio * np.sign(w[used]), atol=1e-6)
            assert (np.abs(slope[~used]) <= penalty * ratio + 1e-6).all()
            assert np.isclose(fit[t][0] + x.mean(0) @ fit[t][1:], y[:, t].mean())
    assert any(c == 0 for fit in path[:1] for c in fit[1][1:6])


def rows_of(spark, n=400):
    """Group 0 has three quarters of all rows."""
    x = F.col("id")
    return spark.range(n).select(
        F.when(x % 4 == 3, 1).otherwise(0).alias("e"), F.date_add(F.lit("2020-01-01").cast("date"), (x / 4).cast("int")).alias("d"),
        x.alias("k"), F.sin(x * 0.7).alias("a"), (x % 11).cast("double").alias("b"),
    ).withColumns({"target_j1": F.col("a") * 3 - F.col("b") + 20, "target_j2": F.col("b") * 2 + 1})


def test_search_refits_on_all_training_days(spark):
    rows = rows_of(spark)
    choices, models, errors = workflows.search_refit(rows, "e", ["a", "b"], 2, [1.0, 0.0], [0.0, 0.5], cols=PanelCols("k", "d", "v", "l"))
    got = {r["e"]: r for r in choices.collect()}
    assert set(got) == {0, 1}
    for r in got.values():
        assert (r["penalty"], len(r["fold_scores"])) == (0.0, 3)
        assert r["score"] < 1e-6 and np.isclose(np.mean(r["fold_scores"]), r["score"])
    for r in models.collect():
        assert np.allclose(r["coefficients"], [[20, 3, -1], [1, 0, 2]], atol=1e-6)
    found = errors.collect()
    assert sorted((r["e"], r["h"]) for r in found) == [(e, h) for e in (0, 1) for h in (0, 1, 2)]
    assert all(r["mae"] < 1e-6 and r["r2"] > 0.999 for r in found)
    consensus = {r["name"]: r["value"] for r in workflows.consensus_choices(choices, "e").collect()}
    assert consensus["penalty"] == 0.0


def test_search_without_enough_rows_gives_nothing(spark):
    rows = rows_of(spark, 4)
    choices, models, errors = workflows.search_refit(rows, "e", ["a"], 2, [1.0], cols=PanelCols("k", "d", "v", "l"))
    assert choices.collect() == [] and models.collect() == [] and errors.collect() == []


def test_rows_of_one_group_meet_their_model_in_several_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = rows_of(spark, 4000)
        models = spark.createDataFrame([(0, [[1.0, 2.0]]), (1, [[0.0, 1.0]])], "e int, coefficients array<array<double>>")
        out = linear.predict_group_linear(rows, models, "e", ["a"], 1)
        tasks = out.filter("e = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) > 3 and max(r["count"] for r in tasks) < 2000
        assert out.count() == 4000
        check = out.select(F.max(F.abs(F.col("pred_j1") - F.when(F.col("e") == 0, 1 + 2 * F.col("a")).otherwise(F.col("a"))))).first()[0]
        assert check < 1e-12
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unlisted_cluster_is_an_error_and_all_are_found(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 7)], "e int, cluster int")
    with pytest.raises(Exception, match="no column for cluster 7"):
        features.one_hot(df, [0, 1]).collect()
    out = features.one_hot(df)
    assert out.columns == ["e", "cluster_0", "cluster_7"]
    assert sorted(map(tuple, out.collect())) == [(1, 1, 0), (2, 0, 0), (3, 0, 1)]


@pytest.mark.parametrize("most", [1, 5, 100])
def test_quantiles_narrow_to_the_rank(spark, most):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.lognormal(0, 8, 3000), np.zeros(700), -rng.lognormal(0, 5, 500), [1e300, -1e300]])
    y = np.full(len(x), 3.5)
    df = spark.createDataFrame([(float(a), float(b), None, float("nan") if i % 2 else 1.0) for i, (a, b) in enumerate(zip(x, y))],
                               "x double, y double, z double, w double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = {(r["name"], r["prob"]): r["quantile"] for r in exact_quantiles(df, ["x", "y", "z", "w"], probs, most).collect()}
    assert len(got) == 24
    for p in probs:
        assert np.isclose(got["x", p], np.quantile(x, p), rtol=1e-9, atol=1e-12)
        assert got["y", p] == 3.5 and got["z", p] is None and got["w", p] == 1.0


def small_panel(spark, days=200, entities=6):
    """The last entity begins after the first fold's validation days."""
    x = F.col("id")
    rows = spark.range(days * entities).select(
        (x % entities).alias("e"), F.date_add(F.lit("2020-01-01").cast("date"), (x / entities).cast("int")).alias("d"),
        ((x % entities + 1) * 10 + (x / entities).cast("int") % 7 + F.when(x / entities >= 150, 500).otherwise(0)).cast("double").alias("v"),
    )
    panel = rows.filter((F.col("e") != entities - 1) | (F.col("d") >= "2020-05-10"))
    day = rows.select("d").distinct()
    table = day.select(
        "d", *[F.lit(0).alias(c) for c in ("IS_WEEKEND", "IS_FERIE", "IS_VACANCES", "IS_PONT")],
        *[F.lit(1.0).alias(c) for c in ("RR", "TN", "TX", "TM", "FFM")],
    )
    medians = spark.createDataFrame([(1.0,) * 5], "RR double, TN double, TX double, TM double, FFM double")
    return panel, features.add_weather_features(features.add_time_features(table, "d"), medians)


def test_levels_of_a_fold_end_before_its_validation_days(spark):
    panel, days = small_panel(spark)
    rows, bounds = tuning.fold_matrix(panel, days, "2020-07-01", 3, 0.4, 1, (1,), (2,), False, cols=C)
    assert [k for k, _, _ in bounds] == [1, 2, 3]
    got = rows.toPandas()
    every = panel.toPandas()
    for fold, first, last in bounds:
        mine = got[got.fold == fold]
        assert mine.d.max() == last and set(mine[mine.d < first].role) == {"train"} and set(mine[mine.d >= first].role) == {"validation"}
        for e, lvl in mine.groupby("e").lvl.first().items():
            before = every[(every.e == e) & (every.d < first)]
            assert np.isclose(lvl, before.v.mean())
        # Without a day before the fold there is no level.
        assert (5 in set(mine.e)) == bool(((every.e == 5) & (every.d < first)).any())


def test_halving_keeps_the_best_and_scores_are_medians(spark):
    panel, days = small_panel(spark)
    grid = {"penalty": [0.001, 50.0, 1000.0, 0.1]}
    options = dict(learner=tuning.net_learner, horizon=1, lags=(1, 7), rolls=(2,), add_profiles=False, names=["lag_1", "lag_7"], cols=C)
    every = tuning.tune(panel, days, "2020-07-01", grid, 4, **options).collect()
    assert sorted((r["config"], r["fold"]) for r in every) == [(c, k) for c in range(4) for k in (1, 2, 3)]
    some = tuning.tune(panel, days, "2020-07-01", grid, 4, keep=0.5, **options)
    kept = {(r["config"], r["fold"]): r["score"] for r in some.collect()}
    assert len(kept) == 4 + 2 + 1
    assert all(np.isclose(kept[r["config"], r["fold"]], r["score"]) for r in every if (r["config"], r["fold"]) in kept)
    first = sorted(((r["score"], r["config"]) for r in every if r["fold"] == 1))[:2]
    assert {c for c, k in kept if k == 2} == {c for _, c in first}
    best = tuning.best_of(some).first()
    assert len(best["fold_scores"]) == 3 and np.isclose(best["score"], np.mean(best["fold_scores"]))


def test_tree_tuning_scores_each_fold(spark):
    panel, days = small_panel(spark)
    grid = {"n_estimators": [1], "max_depth": [1, 2]}
    scores = tuning.tune(panel, days, "2020-07-01", grid, 2, n_folds=2, horizon=1, lags=(1,), rolls=(2,), add_profiles=False,
                         names=["lag_1", "mois"], cols=C).collect()
    assert sorted((r["config"], r["fold"]) for r in scores) == [(0, 1), (0, 2), (1, 1), (1, 2)]
    assert all(r["score"] >= 0 for r in scores)


def test_small_groups_cost_one_model_each_and_no_python_for_moments(spark, capsys):
    rows = rows_of(spark).withColumn("a", F.when(F.col("k") != 8, F.col("a")))
    moments = linear.group_moments(rows, ["e"], ["a", "b"], ["target_j1"])
    moments.explain()
    assert "MapInPandas" not in capsys.readouterr().out
    got = {r["e"]: np.array(r["moments"]).reshape(4, 4) for r in moments.collect()}
    x = rows.filter("e = 1").toPandas()
    assert np.allclose(got[1], moments_of(x[["a", "b"]].to_numpy(), x[["target_j1"]].to_numpy()))
    # A null spoils the products of its own column alone.
    assert np.isnan(got[0][1]).all() and not np.isnan(got[0][2, 2:3]).any() and got[0][0, 0] == 300
    sizes = rows.groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    joined = linear.join_by_share(rows, moments, ["e"], sizes=sizes)
    assert {r[0] for r in joined.select(linear.SHARE).distinct().collect()} == {0} and joined.count() == 400
    large = sizes.withColumn("n", F.when(F.col("e") == 0, linear.SHARE_ROWS + 1).otherwise(1))
    dealt = linear.join_by_share(rows, moments, ["e"], sizes=large)
    shares = {r["e"]: r["n"] for r in dealt.groupBy("e").agg(F.count_distinct(linear.SHARE).alias("n")).collect()}
    assert shares == {0: linear.SHARES, 1: 1} and dealt.count() == 400


def test_groups_are_ordered_alike_in_one_task_and_spread(spark):
    rows = spark.createDataFrame(
        [(g, None if k == 3 else f"2020-01-{k // 3 + 1:02d}", None if k == 5 else k) for g in (1, 2, None) for k in range(40)],
        "g int, d string, k int",
    ).withColumn("d", F.col("d").cast("date"))
    wanted = sorted(splits.ordered_index(rows, "g", "d", "k").collect())
    cuts = sorted(rows.join(splits.group_day_cutoffs(rows, "g", 0.3, "d"), "g").collect(), key=str)
    for most in (0, 100):
        large = splits.large_groups(rows, "g", most)
        assert large.count() == (2 if most == 0 else 0)
        got = splits.ordered_index(rows, "g", "d", "k", large=large)
        assert sorted(got.select("g", "d", "k", "n", "idx").collect()) == sorted(
            splits.ordered_index(rows, "g", "d", "k").select("g", "d", "k", "n", "idx").collect()
        ) and len(wanted) == got.count()
        cut = splits.with_group_cutoff(rows, "g", 0.3, "d", large)
        assert sorted(cut.select("g", "d", "k", "cutoff").collect(), key=str) == cuts


def test_nets_of_many_groups_equal_each_alone():
    rng = np.random.default_rng(4)
    each = []
    for n in (5, 40, 3):
        x = rng.standard_normal((n, 3))
        x[:, 1] = 2.0 if n == 5 else x[:, 1]
        each.append(moments_of(x, rng.standard_normal((n, 2))))
    grid = elastic_net.net_grid([0.3, 0.01], [0.0, 0.5])
    together = elastic_net.net_paths(np.array(each), 3, 2, grid)
    for m, found in zip(each, together):
        assert np.allclose(found, elastic_net.net_path(m.ravel(), 3, 2, grid), atol=1e-9)


def test_stored_rows_are_dealt_out_by_number(spark):
    stored = materialize(spark.range(2000).select(F.lit(1.0).alias("x"), F.col("id").alias("k")).coalesce(1), "narrow")
    assert stored.rdd.getNumPartitions() == 1
    dealt = dealt_out(stored, 150)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert dealt.rdd.getNumPartitions() == 14 and max(r["count"] for r in sizes) < 300
    assert dealt.agg(F.sum("k")).first()[0] == 1999 * 1000
    assert dealt_out(stored, 2000) is stored


def test_folds_and_checks_have_tasks_for_their_rows(spark, monkeypatch, capsys):
    monkeypatch.setattr(session, "tasks_for", lambda s, rows, most=0: 23)
    for module in (tuning, panel):
        monkeypatch.setattr(module, "tasks_for", session.tasks_for)
    facts = spark.createDataFrame([(1, "a", 2.0), (1, "a", 2.0), (None, "b", 3.0)], "e int, d string, v double")
    report = panel.quality_report(facts, facts, "v", C)
    report.explain()
    assert "23" in capsys.readouterr().out
    got = {r["check"]: r["value"] for r in report.collect()}
    assert (got["panel_rows"], got["panel_entities"], got["panel_duplicate_keys"], got["panel_min_value"]) == ("3", "1", "1", "2")


def test_tasks_grow_with_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert tasks_for(spark, 0) == cores
    assert tasks_for(spark, 1_000 * cores, 10) == 100 * cores
