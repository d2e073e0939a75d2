"""Forecast errors per group and horizon, and their summaries.

Everything is a sum over rows, so partial sums combine before the shuffle and a
group with a third of all rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidepanel.functions.quantiles import exact_quantiles
from tidepanel.session import materialize


def _r2(sse: Column, sst: Column, n: Column) -> Column:
    """1 - SSE/SST; without spread 1 if exact else 0; NULL for fewer than two rows."""
    flat = F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(n < 2, F.lit(None).cast("double")).when(sst == 0, flat).otherwise(
        1.0 - sse / F.nullif(sst, F.lit(0.0))
    )


def horizon_metrics(df: DataFrame, group: str, horizon: int, pred="pred_j", true="target_j") -> DataFrame:
    """Long table (group, h, n, mae, mae_pct, r2) from columns target_jh and pred_jh.

    One aggregate with a few sums per horizon; rows are never multiplied by the
    horizon. mae_pct is NULL when the mean true value is 0.
    """
    hs = range(1, horizon + 1)
    aggs = [F.count(F.lit(1)).alias("n")]
    for h in hs:
        t, p = F.col(f"{true}{h}"), F.col(f"{pred}{h}")
        aggs += [
            F.avg(F.abs(t - p)).alias(f"_mae{h}"),
            F.avg(t).alias(f"_mean{h}"),
            F.sum((t - p) * (t - p)).alias(f"_sse{h}"),
            F.var_pop(t).alias(f"_var{h}"),
        ]
    wide = df.groupBy(group).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(h).alias("h"),
                F.col(f"_mae{h}").alias("mae"),
                F.col(f"_mean{h}").alias("true_mean"),
                (F.col(f"_mae{h}") / F.nullif(F.col(f"_mean{h}"), F.lit(0.0)) * 100).alias(
                    "mae_pct"
                ),
                _r2(F.col(f"_sse{h}"), F.col(f"_var{h}") * F.col("n"), F.col("n")).alias("r2"),
            )
            for h in hs
        ]
    )
    return wide.select(group, "n", F.inline(rows))


def entity_metrics(long: DataFrame, group: str, horizon: int) -> DataFrame:
    """One row per group from `horizon_metrics`: overall errors and mae_pct_jh.

    mae and r2 are uniform means over the horizons; mae_pct relates the mean
    error to the mean true value over all horizons.
    """
    per_h = [
        F.max(F.when(F.col("h") == h, F.col("mae_pct"))).alias(f"mae_pct_j{h}")
        for h in range(1, horizon + 1)
    ]
    out = long.groupBy(group).agg(
        F.max("n").alias("n_test"),
        F.avg("mae").alias("mae"),
        F.avg("true_mean").alias("true_mean"),
        # A mean over horizons would skip a NULL r2; only n < 2 makes one, and
        # then for all horizons alike.
        F.avg("r2").alias("r2"),
        *per_h,
    )
    pct = F.col("mae") / F.nullif(F.col("true_mean"), F.lit(0.0)) * 100
    return out.select(
        group, "n_test", "mae", pct.alias("mae_pct"), "r2", *[f"mae_pct_j{h}" for h in range(1, horizon + 1)]
    )


def per_entity_metrics(df: DataFrame, group: str, horizon: int, pred="pred_j", true="target_j") -> DataFrame:
    return entity_metrics(horizon_metrics(df, group, horizon, pred, true), group, horizon)


def aggregate_metrics(per_entity: DataFrame, horizon: int) -> DataFrame:
    """One row of exact medians across entities, NULLs skipped, with counts."""
    pct = ["mae_pct"] + [f"mae_pct_j{h}" for h in range(1, horizon + 1)]
    columns = pct + ["r2"]
    per_entity = materialize(per_entity.select(*columns), "errors")
    medians = exact_quantiles(per_entity, columns, [0.5], stored=True)
    counts = per_entity.agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.count_if(F.col("r2") < 0).alias("_neg"),
        F.count("r2").alias("_n_r2"),
    ).select(
        "n_stations",
        F.when(F.col("_n_r2") > 0, F.col("_neg")).alias("n_r2_neg"),
        F.lit(1).alias("_one"),
    )

    def pick(c, places, name):
        return F.bround(F.max(F.when(F.col("name") == c, F.col("quantile"))), places).alias(name)

    row = medians.agg(
        pick("mae_pct", 2, "mae_pct_median"),
        pick("r2", 4, "r2_median"),
        *[pick(c, 2, c) for c in pct[1:]],
    ).withColumn("_one", F.lit(1))
    return counts.join(row, "_one").drop("_one")


def results_summary(results: DataFrame) -> DataFrame:
    """Number of groups, mean and exact median of MAE and R2."""
    results = materialize(results.select("mae", "r2"), "results")
    q = exact_quantiles(results, ["mae", "r2"], [0.5], stored=True)

    def med(c):
        return F.max(F.when(F.col("name") == c, F.col("quantile")))

    medians = q.agg(med("mae").alias("median_mae"), med("r2").alias("median_r2"))
    means = results.agg(
        F.count(F.lit(1)).alias("n_groups"), F.avg("mae").alias("mean_mae"), F.avg("r2").alias("mean_r2")
    )
    one = F.lit(1).alias("_one")
    return means.select("*", one).join(medians.select("*", one), "_one").drop("_one")


def ranked(results: DataFrame, metric: str = "mae_pct", key: str = "ID_LIEU") -> DataFrame:
    """All results by ascending metric, NULL last."""
    return results.orderBy(F.asc_nulls_last(metric), F.asc(key))


def best(results: DataFrame, metric: str, key: str, k: int = 5) -> DataFrame:
    known = results.filter(F.col(metric).isNotNull())
    return known.orderBy(F.asc(metric), F.asc(key)).limit(k)


def worst(results: DataFrame, metric: str, key: str, k: int = 5) -> DataFrame:
    known = results.filter(F.col(metric).isNotNull())
    return known.orderBy(F.desc(metric), F.asc(key)).limit(k)


def consensus_params(per_entity: DataFrame, whole_numbers: list[str]) -> DataFrame:
    """(name, value): median of each parameter over entities.

    `per_entity` is long (entity, name, value). Values come from a small grid,
    so they are counted first and the percentile sees one weighted row per
    distinct value.
    """
    counted = (
        per_entity.filter(F.col("value").isNotNull())
        .groupBy("name", F.col("value").cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    med = counted.groupBy("name").agg(F.percentile("value", F.lit(0.5), F.col("n")).alias("m"))
    places = F.when(F.col("name").isin(whole_numbers), F.bround("m", 0)).otherwise(F.bround("m", 4))
    return med.select("name", places.alias("value"))


def mean_of(results: DataFrame, column: str, name: str) -> DataFrame:
    return results.agg(F.avg(column).alias(name))


def compare(model: DataFrame, baseline: DataFrame, horizon: int) -> DataFrame:
    """(measure, model, baseline, gain) from two `aggregate_metrics` rows.

    The gain in points is the baseline's error minus the model's, rounded half-even.
    """
    names = ["mae_pct_median"] + [f"mae_pct_j{h}" for h in range(1, horizon + 1)]

    def long(df, name):
        rows = [F.struct(F.lit(c).alias("measure"), F.col(c).alias(name)) for c in names]
        return df.select(F.inline(F.array(*rows)))

    both = long(model, "model").join(long(baseline, "baseline"), "measure")
    return both.withColumn("gain", F.bround(F.col("baseline") - F.col("model"), 2))
