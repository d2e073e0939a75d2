import datetime as dt

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidepanel.columns import PanelCols
from tidepanel.functions.quantiles import exact_quantiles
from tidepanel.operators import baselines, clean, features, matrix, metrics, splits, windows

C = PanelCols("e", "d", "v", "l")
DAY0 = dt.date(2020, 1, 1)


def series(spark, lengths, gaps=(), value=lambda e, k: float(e * 100 + k)):
    rows = [
        (e, DAY0 + dt.timedelta(days=k), value(e, k))
        for e, n in lengths.items()
        for k in range(n)
        if k not in gaps
    ]
    return spark.createDataFrame(rows, "e bigint, d date, v double")


def reference_frame(pdf, lags, rolls, horizon):
    """The chained definition in pandas: lags drop rows, then rolls, then targets."""
    out = []
    for _, g in pdf.sort_values(["e", "d"]).groupby("e"):
        g = g.copy()
        for k in lags:
            g[f"lag_{k}"] = g["v"].shift(k)
        g = g.dropna(subset=[f"lag_{k}" for k in lags])
        for w in rolls:
            g[f"roll_{w}"] = g["v"].shift(1).rolling(w).mean()
        g = g.dropna(subset=[f"roll_{w}" for w in rolls])
        for h in range(1, horizon + 1):
            g[f"target_j{h}"] = g["v"].shift(-h)
        out.append(g.dropna(subset=[f"target_j{h}" for h in range(1, horizon + 1)]))
    return pd.concat(out).sort_values(["e", "d"]).reset_index(drop=True)


@pytest.mark.parametrize("gaps", [(), (3, 4, 17, 40)])
def test_one_pass_equals_chain(spark, gaps):
    df = series(spark, {1: 60, 2: 45, 3: 5}, gaps)
    got = windows.shift_features(df, (1, 7), (7, 30), 7, cols=C).toPandas()
    got = got.sort_values(["e", "d"]).reset_index(drop=True)
    want = reference_frame(df.toPandas(), (1, 7), (7, 30), 7)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)


def test_separate_steps_equal_one_pass(spark):
    df = series(spark, {1: 60, 2: 50})
    chained = windows.add_targets(
        windows.add_rolling(windows.add_lags(df, (1, 7), C), (7, 30), C), 7, C
    )
    once = windows.shift_features(df, (1, 7), (7, 30), 7, cols=C)
    assert chained.exceptAll(once.select(chained.columns)).count() == 0
    assert chained.count() == once.count()


def test_warm_up_of_45_rows_leaves_one(spark):
    df = series(spark, {1: 45})
    assert windows.shift_features(df, (1, 7), (7, 30), 7, cols=C).count() == 1


def test_roll_never_sees_today(spark):
    df = series(spark, {1: 10}, value=lambda e, k: 1000.0 if k == 9 else 1.0)
    last = windows.add_rolling(df, (7,), C).orderBy(F.desc("d")).first()
    assert last["roll_7"] == 1.0


def test_calendar_spaced_fills_gaps_inside_a_series(spark):
    df = series(spark, {1: 10}, gaps=(4, 5))
    out = windows.calendar_spaced(df, C)
    assert out.count() == 10 and out.filter("v is null").count() == 2


def test_weekly_naive_is_exact_on_weekly_series(spark):
    df = series(spark, {1: 80, 2: 70}, value=lambda e, k: float(e * 10 + k % 7))
    long = baselines.weekly_naive_metrics(df, 7, cols=C).collect()
    assert len(long) == 14 and all(r["mae"] == 0 and r["r2"] == 1 for r in long)
    with pytest.raises(ValueError):
        baselines.weekly_naive(df, 8, C)


def test_weekly_naive_by_group_equals_entity_grain_for_single_entity_groups(spark):
    df = series(spark, {1: 80, 2: 70}, value=lambda e, k: float((e * 31 + k * k) % 97))
    with_group = df.withColumn("g", F.col("e") + 10)
    a = baselines.weekly_naive_metrics(df, 7, cols=C).withColumn("g", F.col("e") + 10).drop("e")
    b = baselines.weekly_naive_metrics(with_group, 7, group="g", cols=C)
    assert a.exceptAll(b.select(a.columns)).count() == 0 and a.count() == b.count() == 14


def test_metrics_edge_cases(spark):
    rows = [(1, 0.0, 1.0), (1, 0.0, 1.0), (2, 5.0, 5.0), (2, 5.0, 5.0), (3, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "e int, target_j1 double, pred_j1 double")
    got = {r["e"]: r for r in metrics.horizon_metrics(df, "e", 1).collect()}
    assert got[1]["mae_pct"] is None and got[1]["r2"] == 0.0
    assert got[2]["r2"] == 1.0 and got[2]["mae"] == 0.0
    assert got[3]["r2"] is None


def test_medians_skip_nulls_and_count_negative_r2(spark):
    rows = [(1, 10.0, -0.5, 1.0), (2, 20.0, 0.5, 3.0), (3, None, 0.7, None)]
    df = spark.createDataFrame(rows, "e int, mae_pct double, r2 double, mae_pct_j1 double")
    row = metrics.aggregate_metrics(df, 1).first()
    assert (row["n_stations"], row["mae_pct_median"], row["r2_median"], row["n_r2_neg"]) == (3, 15.0, 0.5, 1)


def test_medians_without_any_value(spark):
    df = spark.createDataFrame([(1, None, None, None)], "e int, mae_pct double, r2 double, mae_pct_j1 double")
    row = metrics.aggregate_metrics(df, 1).first()
    assert row["mae_pct_median"] is None and row["n_r2_neg"] is None and row["n_stations"] == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=60))
def test_exact_quantiles_match_pandas(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 1.0], 4).collect()}
    s = pd.Series(values, dtype=float).dropna()
    for p, q in got.items():
        assert (q is None) if s.empty else abs(q - s.quantile(p)) < 1e-9


def test_exact_quantiles_with_coarse_sketch_and_heavy_ties(spark):
    """A third of all rows share one value and the sketch brackets widely."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 7919 % 10007).cast("double")).alias("x")
    )
    probs = [0.0, 0.1, 0.25, 0.334, 0.5, 0.9, 1.0]
    s = df.toPandas()["x"]
    for accuracy in (50, 1000):
        got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, ["x"], probs, accuracy).collect()}
        for p in probs:
            assert abs(got[p] - s.quantile(p)) < 1e-6


def test_split_indices(spark):
    df = series(spark, {1: 11})
    # int(11 * 0.8) = 8 -> the ninth day.
    assert splits.day_cutoff(df, 0.2, "d").first()[0] == DAY0 + dt.timedelta(days=8)


def test_sliding_folds_brute_force(spark):
    df = series(spark, {1: 23})
    got = sorted((r["fold"], r["pos"], (r["d"] - DAY0).days) for r in splits.sliding_folds(df, 10, 4, "d").collect())
    want = sorted((f, p, f * 4 + p) for f in range(4) for p in range(10))
    assert got == want
    assert splits.sliding_folds(df, 24, 4, "d").count() == 0


def test_context_overlaps_train_and_test(spark):
    fold = splits.sliding_folds(series(spark, {1: 10}), 10, 5, "d")
    parts = splits.train_test_context(fold, F.lit(10), 0.66, 3).collect()
    # round(6.6) = 7 train rows; the test starts three rows earlier.
    assert sorted(r["pos"] for r in parts if r["role"] == "train") == list(range(7))
    assert sorted(r["pos"] for r in parts if r["role"] == "test") == list(range(4, 10))


def test_walk_forward_is_ordered_and_disjoint(spark):
    df = series(spark, {1: 100})
    cutoff = str(DAY0 + dt.timedelta(days=80))
    folds = splits.walk_forward_folds(df, cutoff, 3, 0.5, "d").orderBy("fold").collect()
    bounds = [((f["val_first"] - DAY0).days, (f["val_last"] - DAY0).days) for f in folds]
    assert bounds == [(40, 52), (53, 65), (66, 79)]
    assert {f["level_cutoff"] for f in folds} == {DAY0 + dt.timedelta(days=40)}


def test_ts_cv_blocks_equal_time_series_split(spark):
    df = series(spark, {1: 23}).withColumn("g", F.lit(1))
    blocks = splits.ts_cv_blocks(splits.ordered_index(df, "g", "d", "e"), 3).collect()
    got = {k: sorted(r["idx"] for r in blocks if r["block"] == k) for k in range(4)}
    # 23 // 4 = 5 rows per test block, the first 8 rows only train.
    assert got == {0: list(range(8)), 1: list(range(8, 13)), 2: list(range(13, 18)), 3: list(range(18, 23))}


def test_stratified_sample_is_exact_and_repeatable(spark):
    clusters = spark.range(300).select(F.col("id").alias("ID_LIEU"), (F.col("id") % 3).cast("int").alias("cluster"))
    a = splits.stratified_sample(clusters, 5, 42).collect()
    b = splits.stratified_sample(clusters.repartition(5), 5, 42).collect()
    assert sorted(a) == sorted(b) and len(a) == 15


def day_table(spark, n=800):
    days = spark.range(n).select(F.date_add(F.lit(DAY0), F.col("id").cast("int")).alias("d"))
    sky = days.select("d", *[(F.dayofmonth("d") % 9).cast("double").alias(c) for c in ("RR", "TN", "TX", "TM", "FFM")])
    flags = days.select(
        "d", (F.weekday("d") >= 5).alias("IS_WEEKEND"), F.lit(False).alias("IS_FERIE"),
        (F.month("d") == 7).alias("IS_VACANCES"), F.lit(False).alias("IS_PONT"),
    )
    medians = sky.agg(*[F.median(c).alias(c) for c in ("RR", "TN", "TX", "TM", "FFM")])
    return features.day_features(flags, sky, medians, "d")


def test_pooled_matrix_guards_and_levels(spark):
    panel = series(spark, {1: 700, 2: 700, 3: 40, 4: 100}, value=lambda e, k: 0.0 if e == 2 else float(e * 50 + k % 7))
    cutoff = str(DAY0 + dt.timedelta(days=500))
    rows = matrix.pooled_matrix(panel, day_table(spark), cutoff, 7, (1, 7), (7,), cols=C)
    # 2 has no level, 3 too few rows, 4 no August.
    assert {r["e"] for r in rows.select("e").distinct().collect()} == {1}
    assert rows.columns[2:-8] == matrix.pooled_feature_names((1, 7), (7,))
    level = sum(50 + k % 7 for k in range(500)) / 500
    first = rows.orderBy("d").first()
    assert abs(first["lvl"] - level) < 1e-9
    assert (first["d"] - DAY0).days == 14
    assert abs(first["lag_7"] * level - (50 + 7 % 7)) < 1e-9
    assert first["target_j1"] == 50 + 15 % 7
    assert rows.count() == 700 - 14 - 7
    live = matrix.pooled_matrix(panel, day_table(spark), cutoff, 7, (1, 7), (7,), require_target=False, cols=C)
    assert live.count() == 700 - 14


def test_excluded_window_is_bridged(spark):
    df = series(spark, {1: 20})
    window = (str(DAY0 + dt.timedelta(days=5)), str(DAY0 + dt.timedelta(days=10)))
    out = windows.add_lags(clean.exclude_window(df, window, "d"), (1,), C)
    at = out.filter(F.col("d") == F.lit(DAY0 + dt.timedelta(days=10))).first()
    assert at["lag_1"] == 104.0


def test_profiles_drop_entities_without_august(spark):
    df = series(spark, {1: 366, 2: 100}).join(day_table(spark), "d")
    got = features.entity_profiles(df, C).collect()
    assert [r["e"] for r in got] == [1]


def test_one_hot_of_missing_cluster_is_zero(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "e int, cluster int")
    got = sorted(tuple(r) for r in features.one_hot(df, [0, 1]).collect())
    assert got == [(1, 1, 0), (2, 0, 0)]


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 9.0)], "RR double, TN double")
    got = features.robust_scale(df, ["RR", "TN"]).orderBy("TN").collect()
    assert [r["RR"] for r in got] == [0.0, 0.0, 0.0]
    assert [r["TN"] for r in got] == [-0.25, 0.0, 1.75]
