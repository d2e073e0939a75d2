"""Feature columns: calendar parts, weather, profiles, scaling, one-hot, pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.functions.calendar import time_parts
from tidepanel.functions.quantiles import exact_quantiles


def add_time_features(df: DataFrame, day: str = "JOUR") -> DataFrame:
    return df.withColumns(time_parts(F.col(day)))


def weather_medians(panel: DataFrame, weather: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """One row: median of each weather column over the joined (day, entity) rows.

    A day weighs as many times as it has entities, so the panel is first
    counted per day; the percentile then sees one weighted row per day and
    holds at most the calendar. NULLs are skipped.
    """
    # Counting the value column keeps the panel's columns equal to those of the
    # plan's other branch, which lets Spark reuse its shuffle.
    per_day = panel.groupBy(cols.day).agg(F.count(cols.value).alias("n"))
    joined = per_day.join(weather, cols.day)
    return joined.agg(
        *[F.percentile(c, F.lit(0.5), F.col("n")).alias(c) for c in config.WEATHER_COLUMNS]
    )


def _one_row(stats: DataFrame) -> Column:
    """The single row of `stats` as a struct, read by one scalar subquery."""
    return stats.select(F.struct(*stats.columns)).scalar()


def fill_weather(df: DataFrame, medians: DataFrame) -> DataFrame:
    """Missing weather replaced by the medians."""
    filled = {c: F.coalesce(c, F.col(f"_m.{c}")) for c in config.WEATHER_COLUMNS}
    return df.withColumn("_m", _one_row(medians)).withColumns(filled).drop("_m")


def weather_parts() -> dict[str, Column]:
    """Derived weather columns; an indicator of a NULL measure is 0."""

    def flag(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(False)).cast("int")

    return {
        "amplitude": F.col("TX") - F.col("TN"),
        "log_RR": F.log1p("RR"),
        "is_rain": flag(F.col("RR") >= config.RAIN_MM),
        "is_wind": flag(F.col("FFM") >= config.WIND_MS),
        "is_cold": flag(F.col("TM") <= config.COLD_C),
        "is_hot": flag(F.col("TM") >= config.HOT_C),
    }


def add_weather_features(df: DataFrame, medians: DataFrame) -> DataFrame:
    """Median-filled weather plus amplitude, log rain and four indicators."""
    return fill_weather(df, medians).withColumns(weather_parts())


def build_features(
    df: DataFrame, clusters: DataFrame | None = None, cols: PanelCols = DEFAULT
) -> DataFrame:
    """Calendar and weather features of a joined panel, and the cluster if given.

    Medians are taken over the rows of `df` itself.
    """
    medians = (
        df.groupBy(cols.day)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.max(c).alias(c) for c in config.WEATHER_COLUMNS],
        )
        .agg(*[F.percentile(c, F.lit(0.5), F.col("n")).alias(c) for c in config.WEATHER_COLUMNS])
    )
    out = add_weather_features(add_time_features(df, cols.day), medians)
    return out if clusters is None else add_clusters(out, clusters, cols)


def day_features(
    calendar: DataFrame, weather: DataFrame, medians: DataFrame, day: str = "JOUR"
) -> DataFrame:
    """All features that depend on the day alone, one row per calendar day.

    Joining this small table after the windows keeps some thirty columns out of
    the panel's shuffle and sort. The calendar must cover the panel.
    """
    joined = calendar.join(weather, day, "left")
    return add_weather_features(add_time_features(joined, day), medians)


def profile_columns(
    value: str, day: str, weekend: str = "IS_WEEKEND", holiday: str = "IS_VACANCES", over=None, keep=None
) -> dict[str, Column]:
    """Profile measures as aggregates, or as window expressions when `over` is given.

    `keep` restricts the rows that count (training days). A missing flag group,
    such as no August row, gives NULL, which later drops the entity.
    """
    keep = F.lit(True) if keep is None else keep
    v = F.col(value)

    def stat(fn, cond):
        expr = fn(F.when(keep & cond, v))
        return expr if over is None else expr.over(over)

    def ratio(flag):
        return stat(F.avg, flag) / F.nullif(stat(F.avg, ~flag), F.lit(0.0))

    always = F.lit(True)
    mean, std = stat(F.avg, always), stat(F.stddev_samp, always)
    august = F.month(day) == 8
    return {
        "nb_vald_moyen": mean,
        "nb_vald_std": std,
        "log_vald": F.log1p(mean),
        "cv": std / F.nullif(mean, F.lit(0.0)),
        "ratio_we_sem": ratio(F.col(weekend).cast("boolean")),
        "ratio_vac_horsvac": ratio(F.col(holiday).cast("boolean")),
        "creux_estival": ratio(august),
    }


def entity_profiles(df: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """One profile row per entity; entities with any undefined measure are dropped."""
    measures = profile_columns(cols.value, cols.day)
    out = df.groupBy(cols.entity).agg(*[c.alias(n) for n, c in measures.items()])
    return out.dropna()


def levels_before(df: DataFrame, cutoff, cols: PanelCols = DEFAULT) -> DataFrame:
    """Mean value per entity over days strictly before the cutoff."""
    train = df.filter(F.col(cols.day) < F.lit(cutoff).cast("date"))
    return train.groupBy(cols.entity).agg(F.avg(cols.value).alias("lvl"))


def levels_profiles(df: DataFrame, cutoff, cols: PanelCols = DEFAULT):
    """Levels and profiles of the days strictly before the cutoff."""
    train = df.filter(F.col(cols.day) < F.lit(cutoff).cast("date"))
    return levels_before(df, cutoff, cols), entity_profiles(train, cols)


def add_clusters(df: DataFrame, clusters: DataFrame, cols: PanelCols = DEFAULT) -> DataFrame:
    """Cluster of each entity; NULL where the entity has none."""
    return df.join(clusters.select(cols.entity, "cluster"), cols.entity, "left")


def one_hot(df: DataFrame, values: list[int] | None = None, column: str = "cluster") -> DataFrame:
    """0/1 columns `column_k`, source column dropped; NULL is all 0.

    Without `values` all distinct values of the column get one, in ascending
    order. With them, a value that is not listed is an error, since its row
    would look like one without a value.
    """
    if values is None:
        # The values become columns, so they are few.
        rows = df.select(column).distinct().filter(F.col(column).isNotNull()).collect()
        values = sorted(r[0] for r in rows)
    unknown = F.raise_error(F.concat(F.lit(f"no column for {column} "), F.col(column).cast("string"))).cast("int")
    flags = {
        f"{column}_{k}": F.when(F.col(column).isNull(), 0)
        .when(F.col(column) == k, 1)
        .when(F.col(column).isin(values), 0)
        .otherwise(unknown)
        for k in values
    }
    return df.withColumns(flags).drop(column)


def normalise_by_level(df: DataFrame, columns: list[str], level: str = "lvl") -> DataFrame:
    return df.withColumns({c: F.col(c) / F.col(level) for c in columns})


def denormalise_by_level(df: DataFrame, columns: list[str], level: str = "lvl") -> DataFrame:
    return df.withColumns({c: F.col(c) * F.col(level) for c in columns})


def log_target(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.log1p(c) for c in columns})


def unlog(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.expm1(c) for c in columns})


def robust_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: exact centre (median) and scale (interquartile range) per column."""
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])

    def pick(c, p):
        return F.max(F.when((F.col("name") == c) & (F.col("prob") == p), F.col("quantile")))

    aggs = []
    for c in columns:
        aggs.append(pick(c, 0.5).alias(f"{c}_centre"))
        aggs.append((pick(c, 0.75) - pick(c, 0.25)).alias(f"{c}_scale"))
    return q.agg(*aggs)


def robust_scale(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(x - median) / interquartile range; a column without spread is only centred."""
    wanted = config.SCALED_COLUMNS if columns is None else columns
    present = [c for c in wanted if c in df.columns]
    if not present:
        return df
    stats = robust_stats(df, present)

    def scaled(c):
        spread = F.col(f"_s.{c}_scale")
        return (F.col(c) - F.col(f"_s.{c}_centre")) / F.when(spread == 0, 1.0).otherwise(spread)

    out = df.withColumn("_s", _one_row(stats))
    return out.withColumns({c: scaled(c) for c in present}).drop("_s")


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """z-scores with the population deviation; a constant column is only centred."""
    stats = df.agg(
        *[F.avg(c).alias(f"{c}_m") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_s") for c in columns],
    )

    def z(c):
        spread = F.col(f"_s.{c}_s")
        return (F.col(c) - F.col(f"_s.{c}_m")) / F.when(spread == 0, 1.0).otherwise(spread)

    out = df.withColumn("_s", _one_row(stats))
    return out.withColumns({c: z(c) for c in columns}).drop("_s")
