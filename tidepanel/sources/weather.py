"""Daily weather of one station from delimited files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel import config


def read_weather_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union by name of `;`-separated files, every cell as text.

    Headers may differ in width from file to file, so each file is read with
    its own header and the union is by name.
    """
    frames = [spark.read.csv(p, sep=";", header=True) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def clean_weather(
    raw: DataFrame,
    station: int = config.WEATHER_STATION,
    from_year: int = config.WEATHER_FROM_YEAR,
    day: str = "JOUR",
) -> DataFrame:
    """Rows of one station from a year on, typed; not bounded on the right."""
    measures = [F.col(c).cast("double").alias(c) for c in config.WEATHER_COLUMNS]
    parsed = F.to_date(F.col("AAAAMMJJ").cast("string"), "yyyyMMdd")
    return (
        raw.filter(F.col("NUM_POSTE").cast("bigint") == station)
        .select(parsed.alias(day), *measures)
        .filter(F.year(day) >= from_year)
    )


def load_weather(spark: SparkSession, data_dir: str, files=None, **kw) -> DataFrame:
    paths = [f"{data_dir.rstrip('/')}/{f}" for f in (files or config.WEATHER_FILES)]
    return clean_weather(read_weather_files(spark, paths), **kw)
