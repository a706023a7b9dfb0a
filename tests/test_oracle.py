"""Every registered query against its SQL on DuckDB (the driver's gate, locally)."""

import pytest

from helpers.data import SF_SMALL

import __spark_entry__ as E
from viewlens.checks.compare import compare_one, duck

from viewlens.checks.oracle import oracle_sql
from viewlens.plans.registry import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    r = compare_one(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["CustomerID", "Recency", "Frequency", "Monetary", "AOV", "RFM_Score", "Segment"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["rfm_segments", "search_changing", "content_profile", "mart_genre_flow_links"])
def test_same_result_under_1_8_64_shuffle_partitions(spark, name):
    fn = E.queries()[name]
    results = []
    for n in ("1", "8", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(tuple, fn(spark, SF_SMALL).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
