"""Every registered query of the feature and model operators has an oracle
and matches DuckDB on sf0.001."""

import pytest

from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def _names():
    from pitchlake.plans.queries import QUERIES
    return list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries

    r = compare(spark, name, queries()[name], oracle_sql().get(name), SF, con)
    # nothing persisted outlives a query, so that each proves its own plan
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    assert r.get("ok") is True, r
    assert r["rows"] > 0


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["player", "team", "shots", "goals", "xg", "mean_distance", "mean_angle"]
