import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidepanel.columns import PanelCols
from tidepanel.models import clustering, linear, pooled
from tidepanel.operators import sequences
from tidepanel.plans import workflows

C = PanelCols("e", "d", "v", "l")


def frame(spark, n=600, groups=3):
    x = F.col("id")
    return spark.range(n).select(
        (x % groups).alias("g"),
        x.alias("k"),
        F.date_add(F.lit("2020-01-01").cast("date"), (x / groups).cast("int")).alias("d"),
        F.sin(x * 0.7).alias("a"),
        (x % 11).cast("double").alias("b"),
        F.lit(2016.0).alias("constant"),
    ).withColumns({"target_j1": F.col("a") * 3 - F.col("b") * (F.col("g") + 1) + 5, "target_j2": F.col("b") * 2 + 1})


def test_least_squares_per_group_recovers_coefficients(spark):
    fitted = linear.fit_group_ridge(frame(spark), "g", ["a", "b", "constant"], ["target_j1", "target_j2"], 0.0)
    for r in fitted.collect():
        assert np.allclose(r["coefficients"][0], [5, 3, -(r["g"] + 1), 0], atol=1e-6)
        assert np.allclose(r["coefficients"][1], [1, 0, 2, 0], atol=1e-6)
        assert r["n"] == 200


def test_moments_do_not_depend_on_partitioning(spark):
    a = linear.group_moments(frame(spark).repartition(1), ["g"], ["a", "b"], ["target_j1"])
    b = linear.group_moments(frame(spark).repartition(13), ["g"], ["a", "b"], ["target_j1"])
    a, b = ({r["g"]: r["moments"] for r in x.collect()} for x in (a, b))
    assert all(np.allclose(a[g], b[g]) for g in range(3))


def test_ridge_matches_closed_form(spark):
    pdf = frame(spark).filter("g = 0").toPandas()
    x = pdf[["a", "b"]].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    y = pdf["target_j1"].to_numpy()
    w = np.linalg.solve(z.T @ z + 50 * np.eye(2), z.T @ (y - y.mean())) / x.std(0)
    got = linear.fit_group_ridge(frame(spark).filter("g = 0"), "g", ["a", "b"], ["target_j1"], 50.0).first()
    assert np.allclose(got["coefficients"][0][1:], w)


def test_search_prefers_no_penalty_on_exact_data(spark):
    got = workflows.search_per_group(
        frame(spark).withColumn("e", F.col("k")), "g", ["a", "b"], 2, [0.0, 1000.0], cols=C
    ).collect()
    assert len(got) == 3 and all(r["value"] == 0.0 and r["score"] < 1e-6 for r in got)


def test_per_group_training_skips_small_groups(spark):
    df = frame(spark).filter("not (g = 2 and k > 100)")
    fitted, scores = workflows.train_per_group(df, "g", ["a", "b"], 2, 0.0, cols=C)
    assert {r["g"] for r in fitted.collect()} == {0, 1}
    assert all(r["mae"] < 1e-6 and r["r2"] > 0.999 for r in scores.collect())


def test_linear_regression_is_exact_on_linear_data(spark):
    df = frame(spark, groups=1)
    row = linear.linear_regression(df, F.col("k").cast("string"), ["a", "b"], "target_j1").first()
    assert row["mae"] < 1e-6 and row["mae_cv"] < 1e-6 and row["r2"] > 0.999 and 60 < row["n_test"] < 180


def test_clusters_are_numbered_by_volume(spark):
    rows = [(k, float(k // 5 * 3) + 0.01 * k, 0.1, 1.0, 1.0, 1.0 + 0.001 * k) for k in range(20)]
    profiles = spark.createDataFrame(
        rows, "ID_LIEU int, log_vald double, cv double, ratio_we_sem double, ratio_vac_horsvac double, creux_estival double"
    )
    got = {r["ID_LIEU"]: r["cluster"] for r in clustering.cluster_profiles(profiles, 4, 42, 5).collect()}
    assert got[19] == 0 and len(set(got.values())) == 4


def test_configurations_are_distinct_and_bounded():
    grid = {"a": [1, 2, 3], "b": [1, 2]}
    assert len(pooled.sample_configs(grid, 100, 1)) == 6
    picked = pooled.sample_configs(grid, 4, 1)
    assert len({tuple(sorted(c.items())) for c in picked}) == 4
    assert picked == pooled.sample_configs(grid, 4, 1)


def test_series_are_dense(spark):
    rows = [(1, "2020-01-01", 3.0), (1, "2020-01-04", 5.0), (2, "2020-01-02", 7.0), (2, "2020-01-06", 1.0)]
    df = spark.createDataFrame(rows, "e int, d string, v double").withColumn("d", F.col("d").cast("date"))
    got = {r["e"]: list(r["series"]) for r in sequences.entity_series(df, False, C).collect()}
    # Positions follow the panel's distinct days: 1st, 2nd, 4th, 6th.
    assert got == {1: [3.0, 0.0, 5.0, 0.0], 2: [0.0, 7.0, 0.0, 1.0]}


def test_windows_and_last_week(spark):
    series = spark.createDataFrame([(1, [float(k) for k in range(30)], 30)], "e int, series array<double>, n int")
    cut = sequences.entity_windows(series, 40, 14, 7, 5, C).withColumn(
        "pred", sequences.last_week_forecast(F.col("past"), 3)
    )
    for r in cut.collect():
        s = r["start"]
        assert 0 <= s <= 9 and r["past"] == [float(s + k) for k in range(14)]
        assert r["y"] == [float(s + 14 + k) for k in range(7)] and r["pred"] == [float(s + 7 + k) for k in range(3)]


def test_stored_model_forecasts_like_the_fitted_one(spark, sf_dir):
    from queries import spark_queries as q
    from tidepanel.session import scratch_path
    from tidepanel.sinks.stores import save_bundle
    from tidepanel.sources.stores import load_bundle

    rows, bundle = q._bundle(spark, sf_dir, horizon=1)
    rows = rows.filter("day >= '2001-01-01'")
    stored = load_bundle(spark, save_bundle(bundle, scratch_path(spark, "test")))
    points = rows.select("entity", "day")
    a = pooled.forecast(points, rows, bundle, cols=q.COLS)
    b = pooled.forecast(points, rows, stored, strict=True, cols=q.COLS)
    assert a.count() == points.count() > 0
    assert a.exceptAll(b).count() == 0
    lost = points.limit(1).withColumn("day", F.lit("1990-01-01").cast("date"))
    with pytest.raises(Exception, match="no features"):
        pooled.forecast(lost, rows, stored, strict=True, cols=q.COLS).collect()
    report = workflows.evaluate_per_entity(
        bundle, rows, rows.select("entity", F.lit("x").alias("label")).distinct(), "2001-01-01", q.COLS
    )
    assert report.count() == rows.select("entity").distinct().count()


def test_search_returns_the_lowest_score(spark, sf_dir):
    row = entry.queries()["random_search"](spark, sf_dir).first()
    assert row["score"] > 0 and row["best_fold"] <= row["score"] <= row["worst_fold"]


def test_bundle_sums_the_facts_once(spark, tmp_path, monkeypatch):
    """Matrix, levels, profiles and the weather's medians share one panel."""
    from queries import spark_queries as q

    n = F.col("id")
    facts = spark.range(3 * 2 * 1600).select(
        (n % 3).alias("l_suppkey"), F.date_add(F.lit("1995-01-01").cast("date"), (n / 6).cast("int")).alias("l_shipdate"),
        F.lit("A").alias("l_returnflag"), (n % 13 + 5).cast("double").alias("l_quantity"),
    )
    facts.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = facts.select(F.col("l_shipdate").alias("o_orderdate"), (F.col("l_quantity") * 31.5).alias("o_totalprice"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    asked, trained = [], []
    own = q.i.panel
    monkeypatch.setattr(q.i, "panel", lambda *a: asked.append(a) or own(*a))
    monkeypatch.setattr(q.pooled, "train_pooled", lambda *a, **k: trained.append(a))
    rows, _ = q._bundle(spark, str(tmp_path), horizon=1)
    levels = trained[0][4]
    assert len(asked) == 1
    assert rows.select("entity", "lvl").distinct().count() == levels.count() == 3
    assert rows.join(levels.withColumnRenamed("lvl", "own"), "entity").filter("abs(lvl - own) > 1e-9").count() == 0


def test_evaluations_take_the_tuned_parameters(spark, sf_dir, monkeypatch):
    """All 1,200 trees of depth 12 for each of seven horizons."""
    from tidepanel import config

    asked = []

    class Seen(Exception):
        pass

    def noted(train, features, horizon, params, *more):
        asked.append((horizon, params))
        raise Seen

    monkeypatch.setattr(pooled, "fit_horizons", noted)
    for name in ("holdout_eval", "pooled_eval"):
        with pytest.raises(Seen):
            entry.queries()[name](spark, sf_dir)
    assert asked == [(7, config.POOLED_PARAMS)] * 2
    assert config.POOLED_PARAMS["n_estimators"] == 1200 and config.POOLED_PARAMS["max_depth"] == 12


def test_a_bound_of_summed_errors_is_shared_among_the_rows():
    assert pooled.tree_params({"gamma": 0.5}, 4, 1000)["minInfoGain"] == 0.001
    assert pooled.tree_params({}, 4, 0)["minInfoGain"] == 0


def test_fits_write_no_copy_of_the_matrix(spark, tmp_path, monkeypatch):
    from tidepanel import session

    spark.range(200).selectExpr("id % 7 a", "id % 3 b", "id % 7 + 1 target_j1", "2.0 lvl").write.parquet(f"{tmp_path}/rows")
    written = []
    monkeypatch.setattr(session, "scratch_path", lambda spark, name: written.append(name) or f"{tmp_path}/{name}")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    models = pooled.fit_horizons(rows, ["a", "b"], 1, {"n_estimators": 1, "max_depth": 3, "gamma": 0.5}, 1)
    assert not written and models[0].trees[0].numNodes > 5
    scored = pooled.predict_horizons(rows, models, ["a", "b"])
    assert scored.filter("abs(pred_j1 - target_j1) > 1e-6").count() == 0
