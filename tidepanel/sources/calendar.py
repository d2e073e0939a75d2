"""Generated day table with four independent flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel import config
from tidepanel.functions import calendar as cal


def day_spine(spark: SparkSession, first_year: int, last_year: int, day: str = "JOUR") -> DataFrame:
    """Every day of the years first_year..last_year, both included."""
    first, last = F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(
        F.lit(last_year), F.lit(12), F.lit(31)
    )
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias(day))


def holiday_table(
    spark: SparkSession, first_year: int, last_year: int, day: str = "JOUR"
) -> DataFrame:
    """Public holidays of the years, one row per distinct day, about eleven a year."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return cal.public_holidays(years).select(F.explode("holidays").alias(day))


def with_public_holidays(days: DataFrame, holidays: DataFrame, day: str = "JOUR") -> DataFrame:
    """IS_FERIE by a join with a `holiday_table`, whose size its years bound."""
    marked = F.broadcast(holidays.select(day, F.lit(True).alias("IS_FERIE")))
    return days.join(marked, day, "left").withColumn(
        "IS_FERIE", F.coalesce("IS_FERIE", F.lit(False))
    )


def with_school_holidays(
    days: DataFrame, intervals: DataFrame, day: str = "JOUR", zone: str = "C"
) -> DataFrame:
    """IS_VACANCES: the day lies in a closed interval (`start`, `end`) of the zone.

    Intervals are expanded to their days, so the range match becomes an equi
    join whose size is the number of holiday days.
    """
    free = (
        intervals.filter(F.col("zone") == zone)
        .select(F.explode(F.sequence("start", "end")).alias(day))
        .distinct()
        .withColumn("IS_VACANCES", F.lit(True))
    )
    return days.join(free, day, "left").withColumn(
        "IS_VACANCES", F.coalesce("IS_VACANCES", F.lit(False))
    )


def with_bridges(days: DataFrame, holidays: DataFrame, day: str = "JOUR") -> DataFrame:
    """IS_PONT: a Friday after a holiday Thursday or a Monday before a holiday Tuesday.

    Every holiday names its own bridge day, so this too is an equi join.
    """
    tuesday, thursday = F.weekday(day) == 1, F.weekday(day) == 3
    bridge = F.when(thursday, F.date_add(day, 1)).when(tuesday, F.date_sub(day, 1))
    bridges = holidays.select(bridge.alias(day)).filter(F.col(day).isNotNull())
    marked = F.broadcast(bridges.withColumn("IS_PONT", F.lit(True)))
    return days.join(marked, day, "left").withColumn("IS_PONT", F.coalesce("IS_PONT", F.lit(False)))


def load_calendar(
    spark: SparkSession,
    first_year: int = config.CALENDAR_YEARS[0],
    last_year: int = config.CALENDAR_YEARS[1],
    school_holidays: DataFrame | None = None,
    day: str = "JOUR",
    zone: str = "C",
) -> DataFrame:
    """Day table with IS_WEEKEND, IS_FERIE, IS_VACANCES, IS_PONT.

    Its size is fixed by the year range, so joins may broadcast it safely.
    """
    # The year after the last one holds the New Year's Day of a final bridge.
    holidays = holiday_table(spark, first_year, last_year + 1, day)
    out = day_spine(spark, first_year, last_year, day).withColumn(
        "IS_WEEKEND", cal.is_weekend(F.col(day))
    )
    out = with_bridges(with_public_holidays(out, holidays, day), holidays, day)
    if school_holidays is None:
        out = out.withColumn("IS_VACANCES", F.lit(False))
    else:
        out = with_school_holidays(out, school_holidays, day, zone)
    return out.select(day, *config.CALENDAR_COLUMNS)
