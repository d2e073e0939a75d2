import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidepanel.columns import PanelCols
from tidepanel.operators import entities as en
from tidepanel.operators.components import connected_components

C = PanelCols("e", "d", "v", "l")
DAY0 = dt.date(2020, 1, 1)


def rows(e, first, last, value, label):
    return [(e, DAY0 + dt.timedelta(days=k), float(value), label) for k in range(first, last + 1)]


def panel(spark, *parts):
    return spark.createDataFrame([r for p in parts for r in p], "e bigint, d date, v double, l string")


def actions(spark, df, **kw):
    kw.setdefault("overrides", {})
    return {r["e"]: r for r in en.detect_actions(df, cols=C, **kw).collect()}


def test_successive_ids_are_summed(spark):
    # Six days of overlap is still a succession.
    df = panel(spark, rows(1, 0, 50, 100, "Foo"), rows(2, 44, 90, 100, "foo T12"))
    got = actions(spark, df)
    assert got[1]["action"] == "merge_sum" and got[1]["target"] == 2 and got[1]["overlap"] == 6


@pytest.mark.parametrize("volume, action", [(64, "merge_sum"), (65, "merge_max")])
def test_overlap_of_seven_days_is_decided_by_volume(spark, volume, action):
    df = panel(spark, rows(1, 0, 50, 100, "Foo"), rows(2, 43, 90, volume, "Foo"))
    assert actions(spark, df)[2]["action"] == action


def test_without_common_window_the_maximum_is_kept(spark):
    df = panel(spark, rows(1, 0, 20, 9, "Foo"), rows(2, 10, 40, 1, "Foo"), rows(3, 30, 60, 9, "Foo"))
    assert {r["action"] for r in actions(spark, df).values()} == {"merge_max"}


def test_override_by_any_key_and_skip(spark):
    df = panel(spark, rows(1, 0, 50, 100, "Foo"), rows(2, 0, 50, 10, "Foo"), rows(2, 51, 52, 1, "Bar long"))
    assert actions(spark, df)[1]["action"] == "merge_sum"
    assert actions(spark, df, overrides={"foo": "merge_max"})[1]["action"] == "merge_max"
    assert actions(spark, df)[1]["canonical"] == "bar long"
    assert actions(spark, df, overrides={"bar long": "skip"}) == {}


def test_key_graph(spark):
    pairs = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 2), ("b", 3), ("c", 4)], "key string, e bigint"
    )
    got = {(r["key"], r["e"]): r["group"] for r in en.group_keys(pairs, C).collect()}
    assert {got[k] for k in [("a", 1), ("a", 2), ("b", 2), ("b", 3)]} == {"a"} and got[("c", 4)] == "c"
    df = panel(spark, rows(4, 0, 9, 1, "C"))
    assert actions(spark, df) == {}


def test_null_labels_join_no_group(spark):
    df = panel(spark, rows(1, 0, 9, 1, None), rows(2, 0, 9, 1, None))
    assert actions(spark, df) == {}
    assert en.merge_entities(df, hubs={}, overrides={}, cols=C).count() == 20


def test_hub_takes_the_full_history(spark):
    df = panel(spark, rows(1, 0, 9, 5, "Old"), rows(1, 10, 10, 5, "Hub Place"), rows(2, 0, 10, 1, "Other"))
    out = en.merge_entities(df, overrides={}, hubs={"HUB": ["hub place"]}, cols=C).collect()
    hub = [r for r in out if r["e"] == -1000]
    assert len(hub) == 11 and {r["l"] for r in hub} == {"HUB"} and {r["e"] for r in out} == {-1000, 2}


def test_fused_merge_equals_its_steps(spark):
    rng = random.Random(3)
    parts = []
    for e in range(40):
        a = rng.randrange(0, 60)
        parts.append(rows(e, a, a + rng.randrange(5, 80), rng.randrange(1, 50), f"Place {e // 3}"))
        if e % 7 == 0:
            parts.append(rows(e, a + 200, a + 205, 3, f"Place {e}x"))
    df = panel(spark, *parts)
    hubs = {"H1": ["place 1", "place 2"], "H2": ["place 2", "place 9"]}
    acts = en.detect_actions(df, overrides={}, cols=C)
    moved = en.apply_actions(df, acts, C)
    table = en.hub_table(spark, hubs, -1000)
    steps = en.sum_by_key(en.apply_hubs(moved, en.hub_members(moved, table, C), C), C)
    fused = en.merge_entities(df, overrides={}, hubs=hubs, cols=C)
    key = lambda d: sorted(map(tuple, d.select("d", "e", "v", "l").collect()))
    assert key(steps) == key(fused)
    assert fused.groupBy("d", "e").count().filter("count > 1").count() == 0


def test_overlap_matches_all_pairs(spark):
    rng = random.Random(5)
    lives = []
    for g in range(12):
        for e in range(rng.randrange(1, 9)):
            a = rng.randrange(0, 100)
            lives.append((g, e, DAY0 + dt.timedelta(days=a), DAY0 + dt.timedelta(days=a + rng.randrange(0, 40))))
    df = spark.createDataFrame(lives, "group int, e int, first_day date, last_day date")
    got = {r["group"]: r["overlap"] for r in en.max_overlap_days(df).collect()}
    for g in range(12):
        mine = [x for x in lives if x[0] == g]
        best = max(
            [(min(x[3], y[3]) - max(x[2], y[2])).days for i, x in enumerate(mine) for y in mine[i + 1:]] + [0]
        )
        assert got[g] == best


def components(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = sorted((find(a), find(b)))
        parent[rb] = ra
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(7)
    nodes = [f"n{k:03d}" for k in range(120)]
    edges = {
        "path": list(zip(nodes, nodes[1:])),
        "star": [(nodes[60], n) for n in nodes[10:]],
        "random": [(rng.choice(nodes), rng.choice(nodes)) for _ in range(70)],
        "none": [],
    }[kind]
    got = connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node string"),
        spark.createDataFrame(edges, "a string, b string"),
    )
    assert {r["node"]: r["component"] for r in got.collect()} == components(edges, nodes)
