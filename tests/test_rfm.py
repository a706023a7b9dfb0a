import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.functions import labels as L
from viewlens.operators import rfm as R
from viewlens.operators.ntile import global_ntile, global_ntiles
from viewlens.plans.rfm import rfm_table


def tx(spark, data):
    return spark.createDataFrame(data, S.TRANSACTIONS)


def test_clean_drops_bad_rows(spark):
    d = dt.date(2024, 1, 1)
    data = [("1", 1, d, Decimal("0")), ("2", 1, d, Decimal("-1")), ("3", 1, d, None),
            ("4", 0, d, Decimal("5")), ("5", None, d, Decimal("5")), ("6", 2, d, Decimal("5"))]
    assert [r.Transaction_ID for r in R.clean(tx(spark, data)).collect()] == ["6"]
    a = R.clean_audit(tx(spark, data)).collect()[0]
    assert (a.rows_before, a.rows_after, a.rows_removed, a.customers) == (6, 1, 5, 1)


def test_recency_and_aov(spark):
    data = [("1", 1, dt.date(2024, 1, 10), Decimal("2.00")), ("2", 1, dt.date(2024, 1, 5), Decimal("3.00")),
            ("3", 2, dt.date(2024, 1, 1), Decimal("1.00"))]
    got = {r.CustomerID: r for r in R.base(R.clean(tx(spark, data))).collect()}
    assert got[1].Recency == 1 and got[2].Recency == 10
    assert got[1].AOV == 3.0  # 5 / 2 = 2.5 -> 3 (half up)


def builtin(df, n, key="k"):
    return {r.id: r.t for r in df.select("id", F.ntile(n).over(Window.orderBy(key, "id")).alias("t")).collect()}


def tiles(df, n, key="k"):
    return {r.id: r.tile for r in global_ntile(df, key, n, ["id"], "tile").collect()}


def test_tile_sizes(spark):
    for rows, want in ((7, [2, 2, 1, 1, 1]), (3, [1, 1, 1, 0, 0])):
        got = tiles(spark.createDataFrame([(i, i % 3) for i in range(rows)], "id long, k long"), 5)
        assert [list(got.values()).count(t) for t in range(1, 6)] == want


def test_tiles_equal_builtin_with_heavy_ties(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice([1, 1, 1, 1, 2, 3, 50]) if i % 2 else rnd.randint(0, 10_000), ) for i in range(20_000)]
    df = spark.createDataFrame(data, "id long, k long").repartition(13)
    for n in (5, 7):
        assert tiles(df, n) == builtin(df, n)


def test_tiles_one_value_wide_values_and_nulls(spark):
    big = 1 << 60
    for keys in ([7] * 500, [None] * 40 + list(range(60)), [None] * 30, [-big, big, 0, 1, big - 1, None, -1]):
        df = spark.createDataFrame([(i * 1_000_003, k) for i, k in enumerate(keys)], "id long, k long")
        assert tiles(df, 5) == builtin(df, 5)


def test_ties_beyond_one_number(spark, monkeypatch):
    """Ranges of key and id that do not fit one number: the ids of tied values are cut by passes of their own."""
    big, rnd = 1 << 60, random.Random(5)
    df = spark.createDataFrame([(i * 1_000_003, rnd.choice([-big, 3, 3, 3, big, None])) for i in range(3000)], "id long, k long")
    assert tiles(df, 7) == builtin(df, 7)
    monkeypatch.setattr("viewlens.operators.ntile.BITS", 0)
    near = spark.createDataFrame([(i, i // 900) for i in range(3000)], "id long, k long")
    assert tiles(near, 6) == builtin(near, 6)


def test_missed_brackets_are_widened(spark, monkeypatch):
    """With brackets that hold next to nothing the counts show that a rank is missed."""
    monkeypatch.setattr("viewlens.operators.ntile._sketch_size", lambda rows, cuts: (8, 1e-4))
    rnd = random.Random(6)
    df = spark.createDataFrame([(i, rnd.randrange(10**9)) for i in range(20_000)], "id long, k long").repartition(5)
    assert tiles(df, 9) == builtin(df, 9)


def test_two_passes_whatever_the_values(spark, monkeypatch):
    from viewlens.operators import ntile
    passes = []
    monkeypatch.setattr(ntile, "_settle", lambda *a, real=ntile._settle: (passes.append(1), real(*a))[1])
    rnd = random.Random(8)
    df = spark.createDataFrame([(i, int(10 ** rnd.uniform(0, 12)), rnd.choice([1, 2, 3])) for i in range(30_000)], "id long, wide long, tied long")
    got = global_ntiles(df, {"a": "wide", "b": "tied"}, 5, "id").collect()
    assert {r.id: r.a for r in got} == builtin(df, 5, "wide") and {r.id: r.b for r in got} == builtin(df, 5, "tied")
    assert len(passes) == 1


def test_ids_that_cannot_break_ties_raise(spark):
    with pytest.raises(ValueError, match="not unique"):
        tiles(spark.createDataFrame([(1, 5)] * 10, "id long, k long"), 5)
    with pytest.raises(ValueError, match="have no id"):
        tiles(spark.createDataFrame([(None, 5), (1, 6)], "id long, k long"), 2)


def test_tiles_of_dates_and_decimals(spark):
    rnd = random.Random(3)
    rows = [(i, dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(400)) if i % 9 else None, Decimal(rnd.randrange(10**7)) / 100)
            for i in range(700)]
    df = spark.createDataFrame(rows, "id long, day date, money decimal(18,2)")
    got = global_ntiles(df, {"a": "day", "b": "money"}, 6, "id").collect()
    assert {r.id: r.a for r in got} == builtin(df, 6, "day") and {r.id: r.b for r in got} == builtin(df, 6, "money")


def test_fm_score(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "f int, m int")
    assert [r.fm for r in df.select(L.fm_score(F.col("f"), F.col("m")).alias("fm")).collect()] == [1, 2, 3]


EXPECTED_SEGMENTS = {
    # R -> labels for FM = 1..5
    5: ["Recent Customers", "Potential Loyalist", "Potential Loyalist", "Champions", "Champions"],
    4: ["Recent Customers", "Potential Loyalist", "Potential Loyalist", "Champions", "Champions"],
    3: ["Promising", "Need Attention", "Need Attention", "Loyal Customers", "Loyal Customers"],
    2: ["About to Sleep", "About to Sleep", "At Risk", "At Risk", "At Risk"],
    1: ["Lost", "Hibernating", "Hibernating", "Can't Lose Them", "Can't Lose Them"],
}


def test_segment_truth_table_125(spark):
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "R_Score int, F_Score int, M_Score int")
    out = R.segments(df).collect()
    assert len(out) == 125
    for r in out:
        fm = (r.F_Score + r.M_Score + 1) // 2
        assert r.FM_Score == fm
        assert r.Segment == EXPECTED_SEGMENTS[r.R_Score][fm - 1], (r.R_Score, r.F_Score, r.M_Score)


def test_rfm_scores_equal_builtin_windows(spark):
    from viewlens.plans.rfm import rfm_scores
    from viewlens.sources import testdata as TD
    scored = rfm_scores(TD.transactions(spark, "/root/testdata/sf0.001"))
    w = [6 - F.ntile(5).over(Window.orderBy("Recency", "CustomerID"))]
    w += [F.ntile(5).over(Window.orderBy(c, "CustomerID")) for c in ("Frequency", "Monetary")]
    wrong = scored.select("R_Score", "F_Score", "M_Score", *[c.alias(f"w{i}") for i, c in enumerate(w)])
    assert wrong.filter("R_Score != w0 OR F_Score != w1 OR M_Score != w2").count() == 0


def test_segments_only_for_five_tiles(spark):
    df = spark.createDataFrame([(10, 10, 10)], "R_Score int, F_Score int, M_Score int")
    with pytest.raises(ValueError):
        R.segments(df, n=10)
    assert R.segments(df).first().Segment == "Champions"  # open upper bounds


def test_rfm_invariants(spark):
    from viewlens.sources import testdata as TD
    res = rfm_table(TD.transactions(spark, "/root/testdata/sf0.001"))
    n = res.count()
    assert res.select("CustomerID").distinct().count() == n
    assert res.agg(F.min("Recency")).collect()[0][0] == 1
    seg = R.segment_counts(res).agg(F.sum("count")).collect()[0][0]
    assert seg == n
    sizes = [r.c for r in res.groupBy(F.substring("RFM_Score", 2, 1).alias("f")).agg(F.count("*").alias("c")).collect()]
    assert max(sizes) - min(sizes) <= 1


def test_empty_transactions(spark):
    out = rfm_table(tx(spark, []))
    assert out.count() == 0 and out.columns == S.RFM_COLUMNS


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=0, max_size=60),
       n=st.integers(1, 9), parts=st.integers(1, 5))
def test_distributed_ntile_property(spark, keys, n, parts):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k long").repartition(parts)
    assert tiles(df, n) == builtin(df, n)


def test_ntile_empty_input(spark):
    df = spark.createDataFrame([], "id long, k long")
    out = global_ntile(df, "k", 5, ["id"], "tile")
    assert out.count() == 0 and out.columns == ["id", "k", "tile"]
