"""Entity resolution and serving features that follow a growing panel."""

import datetime as dt

import pytest

from tidepanel.columns import PanelCols
from tidepanel.operators import entities as en, windows
from tidepanel.streaming import resolution, serving

C = PanelCols("e", "d", "v", "l")
DAY0 = dt.date(2020, 1, 1)
SCHEMA = "e bigint, d date, v double, l string"


def rows(e, first, last, value, label):
    return [(e, DAY0 + dt.timedelta(days=k), float(value), label) for k in range(first, last + 1)]


def panel(spark, *parts):
    return spark.createDataFrame([r for p in parts for r in p], SCHEMA)


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def rebuilt(spark, df):
    pairs = en.group_keys(en.key_id_pairs(df, C), C)
    return (
        as_set(pairs, "key", "e", "group"),
        as_set(en.lifetimes(df, C), "e", "first_day", "last_day", "n_days"),
        as_set(en.detect_actions(df, overrides={}, cols=C), "e", "target", "action", "group", "canonical", "overlap"),
    )


def kept(spark, base):
    state = resolution.resolved(spark, base)
    return (
        as_set(state["pairs"], "key", "e", "group"),
        as_set(state["lives"], "e", "first_day", "last_day", "n_days"),
        as_set(state["actions"], "e", "target", "action", "group", "canonical", "overlap"),
    )


def test_state_after_each_batch_equals_a_rebuild(spark, tmp_path):
    base = str(tmp_path / "state")
    with pytest.raises(FileNotFoundError):
        resolution.resolved(spark, base)
    batches = [
        # Two groups of two, an id alone, an id without a label.
        rows(1, 0, 20, 10, "Foo") + rows(2, 15, 40, 9, "foo") + rows(3, 0, 30, 5, "Mid") + rows(4, 0, 30, 5, "mid")
        + rows(5, 0, 9, 1, "Zed") + rows(6, 0, 3, 1, None),
        # A new key that is smaller than all links both groups; the volumes of 3 change.
        rows(2, 41, 45, 900, "Alpha") + rows(3, 31, 33, 500, "alpha"),
        # Nothing new but days, an earlier one among them.
        rows(5, -4, -1, 2, "zed"),
        # Two keys of one new id, one of them known.
        rows(7, 50, 52, 1, "Zed") + rows(7, 53, 53, 1, "Omega"),
    ]
    so_far = []
    for number, batch in enumerate(batches):
        so_far.append(batch)
        for _ in range(2 if number == 1 else 1):  # a replay changes nothing
            resolution.resolve_batch(panel(spark, batch), number, base, overrides={}, cols=C)
        if number != 2:
            assert kept(spark, base) == rebuilt(spark, panel(spark, *so_far))
    assert {r[3] for r in kept(spark, base)[2]} == {"alpha", "omega"}


def test_an_empty_batch_and_rows_without_values(spark, tmp_path):
    base = str(tmp_path / "state")
    resolution.resolve_batch(panel(spark, rows(1, 0, 1, 1, "A"), [(None, DAY0, 1.0, "A"), (2, None, 1.0, "A"), (3, DAY0, None, "A")]), 0, base, overrides={}, cols=C)
    resolution.resolve_batch(spark.createDataFrame([], SCHEMA), 1, base, overrides={}, cols=C)
    assert kept(spark, base) == ({("a", 1, "a")}, {(1, DAY0, DAY0 + dt.timedelta(days=1), 2)}, set())


def test_shifts_after_each_day_equal_the_window_functions(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    # Entity 2 misses days, entity 3 begins late, entity 1 has a late row.
    values = {e: [(e, DAY0 + dt.timedelta(days=k), float(7 * k % 11 + e), "x") for k in range(12) if (k + e) % 5 or e != 2] for e in (1, 2, 3)}
    values[3] = values[3][8:]
    turns = [range(5), range(5, 8), [8], [9, 10], [11]]
    so_far = []
    for days in turns:
        new = [r for own in values.values() for r in own if (r[1] - DAY0).days in days]
        so_far += new
        spark.createDataFrame(new, SCHEMA).write.mode("append").parquet(src)
        for _ in range(2):  # the second run finds no file
            serving.run_serving(spark, src, out, ck, SCHEMA, (1, 2), (3,), None, C)
        got = spark.read.parquet(out).filter("n > 5").select("e", "d", "v", "lag_1", "lag_2", "roll_3")
        want = windows.shift_features(spark.createDataFrame(so_far, SCHEMA).drop("l"), (1, 2), (3,), 0, cols=C)
        assert as_set(got, *got.columns) == as_set(want, *got.columns)
    assert got.count() > 5
    late = [(1, DAY0 + dt.timedelta(days=3), 99.0, "x"), (9, DAY0, 1.0, "x"), (9, DAY0, 2.0, "y"), (9, None, 1.0, "y"), (None, DAY0, 1.0, "y")]
    spark.createDataFrame(late, SCHEMA).write.mode("append").parquet(src)
    serving.run_serving(spark, src, out, ck, SCHEMA, (1, 2), (3,), None, C)
    assert as_set(serving.late_points(spark, out, "bigint", (1, 2), (3,), C), "e", "d", "v") == {(1, late[0][1], 99.0)}
    assert [(r["v"], r["n"]) for r in spark.read.parquet(out).filter("e = 9").collect()] == [(3.0, 1)]


def test_repeated_days_and_late_days_of_one_batch(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.createDataFrame(rows(1, 0, 4, 2, "x"), SCHEMA).write.mode("append").parquet(src)
    serving.run_serving(spark, src, out, ck, SCHEMA, (1,), (2,), None, C)
    # Days 5 and 6 in no order, day 5 twice; day 3 is late.
    again = [*rows(1, 6, 6, 7, "x"), *rows(1, 3, 3, 9, "x"), *rows(1, 5, 5, 1, "x"), *rows(1, 5, 5, 4, "y")]
    spark.createDataFrame(again, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    serving.run_serving(spark, src, out, ck, SCHEMA, (1,), (2,), None, C)
    got = {((r["d"] - DAY0).days, r["v"], r["n"], r["late"], r["lag_1"], r["roll_2"]) for r in spark.read.parquet(out).collect()}
    first = {(k, 2.0, k + 1, False, None if k < 3 else 2.0, None if k < 3 else 2.0) for k in range(5)}
    assert got == first | {(3, 9.0, None, True, None, None), (5, 5.0, 6, False, 2.0, 2.0), (6, 7.0, 7, False, 5.0, 3.5)}
