"""Sequence data: log panels, windows of days, and last-week forecasts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepanel import config
from tidepanel.columns import DEFAULT, PanelCols
from tidepanel.operators.joins import broadcast_if_small
from tidepanel.operators.splits import day_index

MAX_WIDE_COLUMNS = 5_000


def wide_log_panel(
    panel: DataFrame,
    entities: list[int],
    weather: DataFrame | None = None,
    calendar: DataFrame | None = None,
    log: bool = True,
    cols: PanelCols = DEFAULT,
) -> DataFrame:
    """One row per day, one column per listed entity, missing values 0, log1p.

    Weather and calendar are joined by day with NULL as 0, flags become 0/1,
    and month_sin / month_cos are added. For more entities than a schema
    should hold, `entity_series` keeps one row per entity instead.
    """
    if len(entities) > MAX_WIDE_COLUMNS:
        raise ValueError(f"more than {MAX_WIDE_COLUMNS} entities: use entity_series")
    names = [str(e) for e in entities]
    wide = panel.groupBy(cols.day).pivot(cols.entity, entities).agg(F.sum(cols.value))
    wide = wide.fillna(0.0, subset=names)
    if log:
        wide = wide.withColumns({c: F.log1p(F.col(f"`{c}`")) for c in names})
    covariates = []
    if weather is not None:
        wide = wide.join(broadcast_if_small(weather), cols.day, "left")
        covariates += config.WEATHER_COLUMNS
    if calendar is not None:
        flags = [F.col(c).cast("int").alias(c) for c in config.CALENDAR_COLUMNS]
        wide = wide.join(calendar.select(cols.day, *flags), cols.day, "left")
        covariates += config.CALENDAR_COLUMNS
    if covariates:
        wide = wide.fillna(0, subset=covariates)
    angle = F.month(cols.day) * F.lit(2 * math.pi / 12)
    return wide.withColumns({"month_sin": F.sin(angle), "month_cos": F.cos(angle)})


def entity_series(panel: DataFrame, log: bool = True, cols: PanelCols = DEFAULT) -> DataFrame:
    """(entity, series): one array per entity with a value for every day of the panel.

    The long counterpart of the wide panel for any number of entities: one
    shuffle on the entity, arrays as long as the panel has days, gaps filled
    with 0 between consecutive known positions.
    """
    # One row per distinct date: at most 3.7 million short rows by type.
    days = F.broadcast(day_index(panel, cols.day))
    value = F.log1p(cols.value) if log else F.col(cols.value).cast("double")
    known = (
        panel.join(days, cols.day)
        .groupBy(cols.entity)
        .agg(
            F.array_sort(F.collect_list(F.struct("idx", value.alias("v")))).alias("known"),
            F.max("n").alias("n"),
        )
    )
    zeros = lambda k: F.array_repeat(F.lit(0.0), k)
    before = lambda i: F.when(i > 0, F.col("known")[F.greatest(i - 1, F.lit(0))]["idx"]).otherwise(-1)
    dense = F.flatten(
        F.transform("known", lambda x, i: F.concat(zeros(x["idx"] - before(i) - 1), F.array(x["v"])))
    )
    last = F.element_at("known", -1)["idx"]
    return known.select(
        cols.entity, F.concat(dense, zeros(F.col("n") - last - 1)).alias("series"), "n"
    )


def seeded_start(sample: Column, seed: int, choices: Column) -> Column:
    """Reproducible pseudo-random start in [0, choices)."""
    digest = F.md5(F.concat_ws("-", sample.cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), choices).cast("int")


def sample_starts(
    spark: SparkSession, n_samples: int, n_days: int, past: int, future: int, seed: int
) -> DataFrame:
    """(sample, start): seeded window starts in [0, n_days - past - future]."""
    choices = n_days - past - future + 1
    if choices < 1:
        raise ValueError("the panel has fewer days than one window")
    ids = spark.range(n_samples).select(F.col("id").cast("int").alias("sample"))
    return ids.withColumn("start", seeded_start(F.col("sample"), seed, F.lit(choices)))


def entity_windows(
    series: DataFrame, n_samples: int, past: int, future: int, seed: int, cols: PanelCols = DEFAULT
) -> DataFrame:
    """(entity, sample, past, y): seeded windows cut from every entity's series.

    All entities share the starts of a sample. Starts are computed from the
    sample number inside each row, so nothing is joined.
    """
    choices = (F.col("n") - F.lit(past + future) + 1).cast("bigint")

    def cut(sample):
        start = seeded_start(sample, seed, choices)
        return F.struct(sample.alias("sample"), start.alias("start"))

    def slices(w):
        return F.struct(
            w["sample"].alias("sample"),
            w["start"].alias("start"),
            F.slice("series", w["start"] + 1, F.lit(past)).alias("past"),
            F.slice("series", w["start"] + past + 1, F.lit(future)).alias("y"),
        )

    # The cuts are made before the rows multiply, so the whole series is not
    # copied once per sample.
    numbers = F.sequence(F.lit(0), F.lit(n_samples - 1))
    windows = F.transform(F.transform(numbers, cut), slices)
    return series.filter(choices >= 1).select(cols.entity, F.inline(windows))


def sequence_samples(
    wide: DataFrame,
    starts: DataFrame,
    target_columns: list[str],
    past: int,
    future: int,
    past_covariates: list[str] = (),
    future_covariates: list[str] = (),
    day: str = "JOUR",
) -> DataFrame:
    """One row per sample: x_past, x_fut and y as arrays of daily vectors.

    x_past holds targets and past covariates of the first `past` days, x_fut
    the future covariates of all days, y the targets of the last `future`
    days. Starts are expanded to day positions and matched by an equi join.
    """

    def vec(names):
        return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names])

    rows = wide.join(F.broadcast(day_index(wide, day)), day).select(
        "idx",
        vec([*target_columns, *past_covariates]).alias("p"),
        (vec(future_covariates) if future_covariates else F.array().cast("array<double>")).alias("f"),
        vec(target_columns).alias("t"),
    )
    wanted = starts.select(
        "sample",
        "start",
        F.explode(F.sequence(F.col("start"), F.col("start") + past + future - 1)).alias("idx"),
    )
    joined = wanted.join(rows, "idx").withColumn("pos", F.col("idx") - F.col("start"))

    def stacked(cond, column):
        kept = F.collect_list(F.when(cond, F.struct("pos", F.col(column).alias("x"))))
        return F.transform(F.array_sort(kept), lambda s: s["x"])

    return joined.groupBy("sample", "start").agg(
        stacked(F.col("pos") < past, "p").alias("x_past"),
        stacked(F.lit(True), "f").alias("x_fut"),
        stacked(F.col("pos") >= past, "t").alias("y"),
    )


def last_week_forecast(past: Column, horizon: int) -> Column:
    """The first `horizon` of the last seven past values."""
    if not 1 <= horizon <= 7:
        raise ValueError("the last-week forecast needs a horizon of 1 to 7")
    return F.slice(past, F.size(past) - 6, F.lit(horizon))


def entity_sequence_errors(
    df: DataFrame, horizon: int, log: bool = True, cols: PanelCols = DEFAULT
) -> DataFrame:
    """(entity, h, mae, volume): mean absolute error and mean size over the samples.

    `df` has arrays `y` and `pred`. In log space both are taken back by expm1
    of the absolute value.
    """
    back = F.expm1 if log else (lambda c: c)
    aggs = []
    for h in range(horizon):
        y, p = F.get("y", F.lit(h)), F.get("pred", F.lit(h))
        aggs += [
            F.avg(back(F.abs(y - p))).alias(f"_e{h}"),
            F.avg(back(F.abs(y))).alias(f"_v{h}"),
        ]
    wide = df.groupBy(cols.entity).agg(*aggs)
    rows = [
        F.struct(
            F.lit(h + 1).alias("h"), F.col(f"_e{h}").alias("mae"), F.col(f"_v{h}").alias("volume")
        )
        for h in range(horizon)
    ]
    return wide.select(cols.entity, F.inline(F.array(*rows)))


def sequence_score(errors: DataFrame, percent: bool = True, places: int = 3) -> DataFrame:
    """(h, score): mean over entities of error / volume; entities without volume are left out."""
    ratio = F.col("mae") / F.nullif(F.col("volume"), F.lit(0.0))
    mean = F.avg(ratio) * (100 if percent else 1)
    return errors.groupBy("h").agg(F.bround(mean, places).alias("score"))


def entity_error_table(
    panel: DataFrame, errors: DataFrame, cols: PanelCols = DEFAULT
) -> DataFrame:
    """Mean volume, next-day error and relative error per entity, matched by id."""
    volume = panel.groupBy(cols.entity).agg(F.avg(cols.value).alias("mean_value"))
    first = errors.filter(F.col("h") == 1).select(cols.entity, F.col("mae").alias("mae_j1"))
    return volume.join(first, cols.entity).withColumn(
        "error_pct", F.col("mae_j1") / F.nullif(F.col("mean_value"), F.lit(0.0)) * 100
    )
