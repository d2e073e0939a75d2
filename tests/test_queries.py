"""Every registered query against its DuckDB twin, or against itself when it has none."""

import pytest

import __spark_entry__ as entry
from compare import canonical, duck

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
# Model fits are exercised once, in test_models.
MODELS = {"gbt_forecast", "holdout_eval", "random_search", "kmeans_clusters", "pooled_eval"}


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    assert len(entry.entry(spark).limit(1).collect()) == 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_twin(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = duck(sf_dir).execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - MODELS))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
