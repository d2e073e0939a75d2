import pytest
from pyspark.sql import functions as F

from tidepanel.functions import text
from tidepanel.operators import clean


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


def test_days(spark):
    got = column(
        spark,
        ["2016-01-03", "03/01/2016", " 3/1/2016 ", "20160103", "2016-01-03 00:00:00", "01/13/2016", "", None],
        text.parse_day,
    )
    assert [str(d) if d else None for d in got] == ["2016-01-03"] * 5 + ["2016-01-13", None, None]


def test_unreadable_day_is_an_error_only_when_strict(spark):
    with pytest.raises(Exception, match="unreadable day"):
        column(spark, ["soon"], text.parse_day)
    assert column(spark, ["soon"], lambda c: text.parse_day(c, strict=False)) == [None]


def test_ids(spark):
    got = column(spark, ["71", " 71 ", "71.0", "x", "", None, "71d", "9007199254740993"], text.parse_id)
    assert got == [71, 71, 71, None, None, None, None, 9007199254740993]
    with pytest.raises(Exception, match="fractional id"):
        column(spark, ["71.5"], text.parse_id)


def test_counts(spark):
    cells = ["2 093", "2 093", "2 093", "Moins de 5", "moins de 5", "", "12.5", None, "1e3"]
    assert column(spark, cells, text.parse_count) == [
        2093.0, 2093.0, 2093.0, 3.0, None, None, 12.5, None, 1000.0
    ]


LABELS = ["Saint-Martin-D'Etampes", "CHÂTELET-les  halles ", "Foo T12", "foo rer E", None, "l'été 2b", "ÎLE"]


def test_title_matches_python(spark):
    want = [None if t is None else " ".join(t.split()).title() for t in LABELS]
    assert column(spark, LABELS, text.title_label) == want


def test_label_key(spark):
    assert column(spark, LABELS, text.label_key) == [
        "saint martin d etampes", "chatelet les halles", "foo", "foo", "", "l ete 2b", "ile"
    ]


def test_drop_ids_keeps_rows_without_id(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "ID_LIEU bigint")
    assert sorted(str(r[0]) for r in clean.drop_ids(df, [0]).collect()) == ["1", "None"]


def test_keep_and_rename_ignore_absent_columns(spark):
    df = spark.createDataFrame([(1, "a")], "lda bigint, NB_VALD string")
    out = clean.keep_columns(clean.harmonise_columns(df))
    assert out.columns == ["ID_LIEU", "NB_VALD"]


def test_only_formats_that_may_fit_are_tried(spark):
    days = ["1997-05-03", "1997/5/3", "19970503", "1997-5-3 1:2:3", "1997-05-03T01:02:03", "5/3/1997", "12/25/1997", "5-3-1997",
            "12-25-1997", "5.3.1997", "5/3/1997 1:2", "5/3/1997 1:2:3", "0005/3/1997", "97-5-3", "5/3/97", "1997", "x"]
    pairs = [f for f in text.DAY_FORMATS]
    df = spark.createDataFrame([(d,) for d in days], "t string")
    for f in pairs:
        read = F.try_to_date("t", f).isNotNull()
        assert df.filter(read & ~text._may_fit(F.col("t"), f)).count() == 0
    tried = {r["t"]: r["n"] for r in df.select("t", sum(text._may_fit(F.col("t"), f).cast("int") for f in pairs).alias("n")).collect()}
    # Of twelve formats; a day-first text no longer fails at the year-first ones.
    assert tried["5/3/1997"] == 2 and tried["x"] == 0 and max(tried.values()) <= 6
