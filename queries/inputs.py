"""How the driver tables stand in for raw counts, weather and calendar.

The SQL snippets below only shape inputs; both engines run the same text, so a
twin differs from its query in the operators alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel.columns import PanelCols
from tidepanel.operators import features
from tidepanel.operators.joins import join_by_day
from tidepanel.operators.panel import daily_panel
from tidepanel.session import materialize
from tidepanel.sources.calendar import load_calendar

COLS = PanelCols(entity="entity", day="day", value="value", label="label")

YEARS = (1995, 2001)
TRAIN_FROM = "1996-01-01"
EXCLUDED = ("1997-01-01", "1998-01-01")
CUTOFF = "2000-06-01"
WEATHER_STATION = 75114001
HORIZON = 7
EVAL_LAGS = (1, 7, 30)
LAGS = (1, 2, 3, 4, 5, 6, 7)
ROLLS = (7, 14, 30)
OVERRIDES = {"gare 000000004": "merge_sum", "gare 000000020": "skip"}
HUBS = {
    "HUB_NORTH": ["quai 000000002", "quai 000000003"],
    "HUB_SOUTH": ["quai 000000003", "quai 000000006", "gare 000000008"],
}
HUB_BASE = -1000
# Entities of the feature lookup; the last is not there.
LOOKED_UP = (1, 2, 5, 7, -4)

# School holidays: (month, day, length in days) of the closed intervals of a year.
SCHOOL_BREAKS = {"C": [(2, 10, 15), (7, 5, 57), (12, 20, 14)], "A": [(3, 1, 20)]}

# Weather of a day out of its orders, in exact arithmetic on cents.
CENTS = "CAST(ROUND(o_totalprice * 100) AS BIGINT)"
WEATHER_SELECT = f"""
    CAST(o_orderdate AS DATE) AS day,
    CAST(SUM({CENTS}) % 1000 AS DOUBLE) / 100 AS RR,
    CAST(MIN({CENTS}) % 2000 AS DOUBLE) / 100 - 5 AS TN,
    CAST(MIN({CENTS}) % 2000 + MAX({CENTS}) % 2000 AS DOUBLE) / 100 - 5 AS TX,
    CAST(2 * (MIN({CENTS}) % 2000) + MAX({CENTS}) % 2000 AS DOUBLE) / 200 - 5 AS TM,
    CAST(COUNT(*) * 2 AS DOUBLE) AS FFM
"""

# Raw text cells of a fact: two day formats, odd ids, blanks and censored counts.
# U+202F is the narrow no-break space of some raw files.
NARROW = " "
RAW_THOUSANDS = "CAST(CAST(l_quantity AS BIGINT) * 97 AS BIGINT)"


def raw_cells(day_iso: str, day_slash: str) -> str:
    """Raw text columns; the two day texts are each engine's own formatting."""
    n = RAW_THOUSANDS
    rest = f"LPAD(CAST({n} % 1000 AS STRING), 3, '0')"
    head = f"CAST(CAST(FLOOR({n} / 1000) AS BIGINT) AS STRING)"
    return f"""
    CASE WHEN l_linenumber % 2 = 0 THEN {day_iso} ELSE {day_slash} END AS JOUR,
    CASE WHEN l_suppkey % 10 = 3 THEN CONCAT(CAST(l_suppkey AS STRING), '.0')
         WHEN l_suppkey % 10 = 7 AND l_linenumber = 1 THEN CONCAT('x', CAST(l_suppkey AS STRING))
         ELSE CAST(l_suppkey AS STRING) END AS lda,
    l_returnflag AS CATEGORIE_TITRE,
    CASE WHEN l_quantity < 5 THEN 'Moins de 5'
         WHEN l_linenumber = 7 AND l_quantity > 45 THEN ''
         WHEN {n} < 1000 THEN CAST({n} AS STRING)
         WHEN l_linenumber % 3 = 0 THEN CONCAT({head}, ' ', {rest})
         WHEN l_linenumber % 3 = 1 THEN CONCAT({head}, '{NARROW}', {rest})
         ELSE CONCAT({head}, {rest}) END AS NB_VALD
    """


# Labels and values of the multi-id panel, by supplier key k (column `entity`).
#   k % 8 = 0, 1 : one label, the second id takes over from the first
#   k % 8 = 4, 5 : one label, parallel lives (k % 16 = 5 at a third of the volume)
#   k % 16 = 13  : label of id k - 1 until 1999, then a label shared with k + 1
#   other        : a label of its own
PAD = "LPAD(CAST({0} AS STRING), 9, '0')"
ENTITY_LABEL = f"""
    CASE WHEN entity % 16 = 13 AND day >= DATE '1999-01-01' THEN CONCAT('éclair  T4 ', {PAD.format('entity')})
         WHEN entity % 16 = 14 THEN CONCAT('Eclair-', {PAD.format('entity - 1')})
         WHEN entity % 8 IN (0, 4) THEN CONCAT(' gâre   ', {PAD.format('entity')})
         WHEN entity % 8 IN (1, 5) THEN CONCAT('GARE ', {PAD.format('entity - 1')}, ' rer b')
         ELSE CONCAT('quai ', {PAD.format('entity')}) END
"""
ENTITY_VALUE = "CASE WHEN entity % 16 = 5 THEN value * 0.25 ELSE value END"
ENTITY_ALIVE = """
    NOT (entity % 8 = 0 AND day >= DATE '1998-06-01')
    AND NOT (entity % 8 = 1 AND day < DATE '1998-05-29')
"""

# A noisy label for label normalisation, by part.
PART_LABEL = """
    CONCAT('  ', CASE WHEN p_partkey % 3 = 0 THEN 'châtelet-LES   ' ELSE 'saint-martin d''' END,
           p_name, CASE WHEN p_partkey % 4 = 0 THEN ' T12' WHEN p_partkey % 4 = 1 THEN ' RER E' ELSE '' END)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed facts without label: entity, day, category, quantity."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_returnflag").alias("category"),
        F.col("l_quantity").alias("quantity"),
    )


def labelled_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("entity"), F.col("s_name").alias("label")
    )
    return facts(spark, sf_dir).join(supplier, "entity")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals per entity, without label."""
    rows = facts(spark, sf_dir).withColumn("label", F.lit(None).cast("string"))
    return daily_panel(rows, "quantity", COLS).drop("label")


def multi_id_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel whose ids share, change and inherit labels."""
    base = panel(spark, sf_dir)
    return base.filter(F.expr(ENTITY_ALIVE)).select(
        "entity", "day", F.expr(ENTITY_VALUE).alias("value"), F.expr(ENTITY_LABEL).alias("label")
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather out of all orders, stored once.

    Medians and joins then read a small file, whose size Spark itself checks
    before it broadcasts, and the orders are scanned a single time.
    """
    orders = table(spark, sf_dir, "orders")
    day, *measures = [c.strip() for c in _split(WEATHER_SELECT)]
    daily = orders.groupBy(F.expr(day)).agg(*[F.expr(m) for m in measures])
    return materialize(daily, "weather")


def _split(select: str) -> list[str]:
    """Top-level comma-separated items of a select list."""
    items, depth, current = [], 0, ""
    for ch in select:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            items.append(current)
            current = ""
        else:
            current += ch
    return [*items, current]


def school_holidays(spark: SparkSession) -> DataFrame:
    years = spark.range(YEARS[0] - 1, YEARS[1] + 1).select(F.col("id").cast("int").alias("y"))
    parts = [
        years.select(
            F.lit(zone).alias("zone"),
            F.make_date("y", F.lit(m), F.lit(d)).alias("start"),
            F.date_add(F.make_date("y", F.lit(m), F.lit(d)), n).alias("end"),
        )
        for zone, breaks in SCHOOL_BREAKS.items()
        for m, d, n in breaks
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def calendar(spark: SparkSession) -> DataFrame:
    return load_calendar(spark, *YEARS, school_holidays(spark), day="day")


def joined_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_day_tables(spark, panel(spark, sf_dir), weather(spark, sf_dir))


def with_day_tables(spark: SparkSession, rows: DataFrame, sky: DataFrame) -> DataFrame:
    return join_by_day(rows, sky, F.broadcast(calendar(spark)), day="day")


def day_table(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Features of every day; `rows` is the panel, if it is there already."""
    sky = weather(spark, sf_dir)
    medians = features.weather_medians(panel(spark, sf_dir) if rows is None else rows, sky, COLS)
    return features.day_features(calendar(spark), sky, medians, "day")


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity to group: the supplier's nation."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("entity"), F.col("s_nationkey").alias("cluster")
    )


def event_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense small panel: daily number of events per type."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.col("event_type").alias("entity"), F.to_date("ts").alias("day")
    ).agg(F.count(F.lit(1)).cast("double").alias("value"))


def rounded(df: DataFrame, places: int = 6, exact: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded for comparison, but for columns that are exact in any engine."""
    doubles = {c for c, t in df.dtypes if t in ("double", "float") and c not in exact}
    return df.select(*[F.round(c, places).alias(c) if c in doubles else F.col(c) for c in df.columns])
