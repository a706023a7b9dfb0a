"""Same results when the inputs arrive in many map tasks.

The benchmark files are single row groups, so their scans are one task;
repartitioning the adapters' output makes every partial aggregate, partial
window limit and range sort work across several map tasks.
"""

from helpers.data import SF_SMALL

from viewlens.plans.content import content_table
from viewlens.plans.rfm import rfm_table
from viewlens.plans.search import search_change
from viewlens.sources import testdata as TD


def same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_rfm_many_map_tasks(spark):
    tx = TD.transactions(spark, SF_SMALL)
    assert same(rfm_table(tx), rfm_table(tx.repartition(7)))


def test_content_many_map_tasks(spark):
    flat = TD.content_log(spark, SF_SMALL)
    assert same(content_table(flat), content_table(flat.repartition(5)))
    assert same(content_table(flat, labels="period"), content_table(flat.repartition(5), labels="period"))


def test_search_many_map_tasks(spark):
    log, mapping = TD.search_log_tagged(spark, SF_SMALL), TD.keyword_mapping_tagged(spark, SF_SMALL)
    base = search_change(log, mapping)
    assert same(base, search_change(log.repartition(6), mapping.repartition(3)))
    assert same(base, search_change(log.repartition(6), mapping.repartition(3), salt_buckets=5))
