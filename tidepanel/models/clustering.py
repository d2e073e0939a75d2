"""Entity clusters from profiles."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.operators.features import entity_profiles, standard_scale
from tidepanel.session import materialize


def cluster_profiles(
    profiles: DataFrame,
    n: int = config.N_CLUSTERS,
    seed: int = 42,
    restarts: int = 10,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """(entity, cluster): k-means on z-scored profiles, best of several seeds.

    Clusters are numbered by falling mean log level, so equal clusterings get
    equal numbers.
    """
    scaled = standard_scale(profiles, config.PROFILE_COLUMNS)
    vectors = VectorAssembler(inputCols=config.PROFILE_COLUMNS, outputCol="features").transform(
        scaled
    ).select(cols.entity, "features", F.col("log_vald").alias("_level"))
    vectors = materialize(vectors, "profiles")
    fits = [
        KMeans(k=n, seed=seed + i, featuresCol="features", predictionCol="_c").fit(vectors)
        for i in range(restarts)
    ]
    best = min(fits, key=lambda m: m.summary.trainingCost)
    found = best.transform(vectors).select(cols.entity, "_level", "_c")
    # At most n rows.
    rank = (
        found.groupBy("_c")
        .agg(F.avg("_level").alias("_m"))
        .withColumn(
            "cluster",
            (F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("_m"), "_c")) - 1),
        )
    )
    return found.join(F.broadcast(rank), "_c").select(cols.entity, "cluster")


def cluster_entities(
    df: DataFrame, n: int = config.N_CLUSTERS, seed: int = 42, restarts: int = 10, cols: PanelCols = DEFAULT
) -> DataFrame:
    return cluster_profiles(entity_profiles(df, cols), n, seed, restarts, cols)
