"""Day expressions: calendar parts, Easter, public holidays."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values: (month, day) of the eight French public holidays on fixed dates.
FIXED_HOLIDAYS = [(1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25)]
# Days after Easter Sunday of Easter Monday, Ascension, Whit Monday.
EASTER_OFFSETS = [1, 39, 50]


def with_easter(years: DataFrame, year: str = "year") -> DataFrame:
    """Adds `easter`, the Gregorian Easter Sunday by the published anonymous
    (Meeus/Butcher) rule.

    Each quantity is a column of its own, so no expression is repeated.
    """

    def div(x: Column, n: int) -> Column:
        return F.floor(x / F.lit(n)).cast("int")

    y, c = F.col(year), F.col
    out = years.withColumns({"_golden": y % 19, "_century": div(y, 100), "_short": y % 100})
    out = out.withColumn("_moon", div(c("_century") - div(c("_century") + 8, 25) + 1, 3))
    out = out.withColumn(
        "_epact",
        (c("_golden") * 19 + c("_century") - div(c("_century"), 4) - c("_moon") + 15) % 30,
    )
    out = out.withColumn(
        "_weekday",
        ((c("_century") % 4) * 2 + div(c("_short"), 4) * 2 - c("_epact") - c("_short") % 4 + 32) % 7,
    )
    out = out.withColumn("_late", div(c("_golden") + c("_epact") * 11 + c("_weekday") * 22, 451))
    out = out.withColumn("_march", c("_epact") + c("_weekday") - c("_late") * 7 + 114)
    out = out.withColumn("easter", F.make_date(y, div(c("_march"), 31), c("_march") % 31 + 1))
    return out.select(*years.columns, "easter")


def public_holidays(years: DataFrame, year: str = "year") -> DataFrame:
    """Adds `holidays`, the distinct French national holidays of the year."""
    fixed = [F.make_date(year, F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    moving = [F.date_add("easter", n) for n in EASTER_OFFSETS]
    listed = F.array_distinct(F.array(*fixed, *moving))
    return with_easter(years, year).withColumn("holidays", listed).drop("easter")


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def time_parts(day: Column) -> dict[str, Column]:
    """Calendar features of a day, Monday = 0, ISO week."""
    angle = F.month(day) * F.lit(2 * math.pi / 12)
    return {
        "jour_semaine": F.weekday(day),
        "jour_mois": F.dayofmonth(day),
        "jour_annee": F.dayofyear(day),
        "semaine_annee": F.weekofyear(day),
        "mois": F.month(day),
        "trimestre": F.quarter(day),
        "annee": F.year(day),
        "is_debut_mois": (F.dayofmonth(day) <= 5).cast("int"),
        "is_fin_mois": (F.dayofmonth(day) >= 25).cast("int"),
        "mois_sin": F.sin(angle),
        "mois_cos": F.cos(angle),
    }
