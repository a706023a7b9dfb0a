from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.functions.exact import ratio_half_even, ratio_half_up
from viewlens.operators import marts as M


def test_exact_rounding(spark):
    df = spark.createDataFrame([(9, 4), (5, 2), (7, 2), (0, 3), (1, 0)], "n long, d long")
    out = df.select(ratio_half_even(F.col("n"), F.col("d"), 1).alias("e"),
                    ratio_half_up(F.col("n"), F.col("d"), 0).alias("u")).collect()
    assert [r.e for r in out] == [2.2, 2.5, 3.5, 0.0, None]
    assert [r.u for r in out] == [2.0, 3.0, 4.0, 0.0, None]


def content_rows(spark, data):
    schema = ", ".join(["Contract string", "Total_Devices long"] + [f"{c} long" for c in S.duration_columns()]
                       + ["MostWatch string", "Taste string", "Active string"])
    return spark.createDataFrame(data, schema)


def test_empty_content_kpis_are_zero(spark):
    r = M.content_kpis(content_rows(spark, [])).collect()[0]
    assert (r.users, r.high_pct, r.avg_devices, r.total_duration) == (0, 0.0, 0.0, 0)


def test_change_filters(spark):
    df = spark.createDataFrame([("1", "No Change"), ("2", "X -> Y"), ("3", None)],
                               "user_id string, Changing string").withColumn("Genre_T6", F.lit("X")) \
        .withColumn("Genre_T7", F.lit("Y"))
    assert [r.user_id for r in M.search_filtered(df, change="unchanged").collect()] == ["1"]
    assert sorted(r.user_id for r in M.search_filtered(df, change="changed").collect()) == ["2", "3"]
    st = {r.Status: r.Count for r in M.change_status(df).collect()}
    assert st == {"Unchanged": 1, "Changed": 2}


def test_membership_filter_drops_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "Segment string")
    assert [r.Segment for r in M.rfm_filtered(df, ["a", "c"]).collect()] == ["a"]
    assert sorted(r.Segment for r in M.rfm_filtered(df).collect()) == ["a", "b"]  # the default selection


def test_reports_are_sorted(spark):
    df = spark.createDataFrame([(i, 1, 1, float(10 * (i % 3)), 1.0, "111", "cab"[i % 3]) for i in range(10)],
                               "CustomerID long, Recency int, Frequency long, Monetary double, AOV double, RFM_Score string, Segment string")
    assert [(r.Segment, r.Count) for r in M.rfm_segment_counts(df).collect()] == [("c", 4), ("a", 3), ("b", 3)]
    assert [r.Segment for r in M.rfm_segment_share(df).collect()] == ["c", "a", "b"]
    assert [r.Segment for r in M.rfm_segment_revenue(df).collect()] == ["b", "a", "c"]
    assert [r.Segment for r in M.rfm_segment_stats(df).collect()] == ["c", "a", "b"]
    s = spark.createDataFrame([("1", "x", "B", "y", "A", None)] * 2 + [("2", "x", "A", "y", "C", None)],
                              "user_id string, Most_Searched_T6 string, Genre_T6 string, Most_Searched_T7 string, Genre_T7 string, Changing string")
    assert [tuple(r) for r in M.genre_compare(s).collect()] == [("B", 2, 0), ("A", 1, 2), ("C", 0, 1)]
    c = content_rows(spark, [(str(i), 1, 0, 0, 0, 0, 0, "yx"[i % 2], "", "Low") for i in range(5)])
    assert [r.MostWatch for r in M.most_watch_stats(c).collect()] == ["y", "x"]


def test_means_skip_nulls(spark):
    df = spark.createDataFrame([(1, 2, 4, 10.0, 5.0, "111", "a"), (None, None, None, None, None, None, "a")],
                               "CustomerID long, Recency int, Frequency long, Monetary double, AOV double, RFM_Score string, Segment string")
    k = M.rfm_kpis(df).first()
    assert (k.customers, k.avg_recency, k.avg_frequency, k.avg_monetary, k.avg_aov) == (2, 2.0, 4.0, 10.0, 5.0)
    r = M.rfm_segment_stats(df).first()
    assert (r.Customers, r.Avg_Recency, r.Avg_Monetary, r.Total_Revenue) == (1, 2.0, 10.0, 10.0)
    c = content_rows(spark, [("1", 3, 4, None, 0, 0, 0, "x", "", "High"), ("2", None, None, None, 0, 0, 0, "x", "", "Low")])
    assert M.content_kpis(c).first().avg_devices == 3.0
    assert M.most_watch_stats(c).first().Avg_Devices == 3.0


def test_search_without_the_change_column(spark):
    df = spark.createDataFrame([("1", "A", "B"), ("2", None, "B")], "user_id string, Genre_T6 string, Genre_T7 string")
    kept = M.search_filtered(df, change="changed")
    assert [r.user_id for r in kept.collect()] == ["1"]  # NULL genres are outside the default selection
    assert M.search_kpis(kept).columns == ["users", "genres_t6", "genres_t7"]


def test_histogram_covers_all_rows(spark):
    data = [(str(i), i % 13, 0, 0, 0, 0, 0, "Truyền Hình", "", "High") for i in range(200)]
    h = M.device_histogram(content_rows(spark, data))
    assert h.agg(F.sum("Count")).collect()[0][0] == 200
    assert h.agg(F.max("bin")).collect()[0][0] <= 39


def test_flow_nodes_are_dense(spark):
    data = [(str(i), "A", "G" + str(i % 3), "B", "G" + str(i % 4), None) for i in range(50)]
    df = spark.createDataFrame(data, "user_id string, Most_Searched_T6 string, Genre_T6 string, "
                                     "Most_Searched_T7 string, Genre_T7 string, Changing string")
    nodes = M.genre_flow_nodes(df, 20).orderBy("node_index").collect()
    assert [r.node_index for r in nodes] == list(range(len(nodes)))
    links = M.genre_flow_links(df, 20).collect()
    assert sum(r.value for r in links) == 50


def test_guards_and_preview(spark):
    import pytest
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    assert M.require_columns(df, ["k"]) is df
    with pytest.raises(M.ResultTableError):
        M.require_columns(df, ["Genre_T6", "Genre_T7"], "customer_search_stats")
    assert not M.is_empty(df) and M.is_empty(df.filter("k > 5"))
    assert [r.k for r in M.preview(df, ["k"], 2).collect()] == [1, 2]


def test_histogram_edge_cases(spark):
    one = [(str(i), 3, 0, 0, 0, 0, 0, "Truyền Hình", "", "High") for i in range(5)]
    h = M.device_histogram(content_rows(spark, one)).collect()
    assert [(r.bin, r.Count, r.bin_start, r.bin_end) for r in h] == [(0, 5, 3.0, 3.0)]
    assert M.device_histogram(content_rows(spark, [])).count() == 0
    skew = [(str(i), 1, 0, 0, 0, 0, 0, "Truyền Hình", "", "High") for i in range(99)] + \
           [("x", 1000, 0, 0, 0, 0, 0, "Truyền Hình", "", "High")]
    h = M.device_histogram(content_rows(spark, skew)).collect()
    assert sum(r.Count for r in h) == 100  # the outlier is clipped into the cap


def _one_by_one(r, c, s):
    out = {"rfm_kpis": M.rfm_kpis(r), "rfm_segment_counts": M.rfm_segment_counts(r), "rfm_segment_revenue": M.rfm_segment_revenue(r),
           "rfm_segment_share": M.rfm_segment_share(r), "top_rfm_scores": M.top_rfm_scores(r, 20), "rfm_segment_stats": M.rfm_segment_stats(r),
           "content_kpis": M.content_kpis(c), "content_durations": M.content_durations(c), "content_most_watch": M.content_most_watch(c),
           "content_active": M.content_active(c), "top_taste15": M.top_taste(c, 15), "content_avg_durations": M.content_avg_durations(c),
           "device_histogram": M.device_histogram(c), "most_watch_active": M.most_watch_active(c), "top_taste20": M.top_taste(c, 20),
           "most_watch_stats": M.most_watch_stats(c), "search_kpis": M.search_kpis(s), "genre_t6": M.genre_counts(s, "Genre_T6"),
           "genre_t7": M.genre_counts(s, "Genre_T7"), "genre_compare": M.genre_compare(s), "top_keywords_t6": M.top_keywords(s, "Most_Searched_T6", 15),
           "top_keywords_t7": M.top_keywords(s, "Most_Searched_T7", 15), "genre_matrix": M.genre_matrix(s),
           "genre_matrix_wide": M.genre_matrix_wide(s), "genre_flow": M.genre_flow(s, 20), "genre_flow_nodes": M.genre_flow_nodes(s, 20),
           "genre_flow_links": M.genre_flow_links(s, 20)}
    if "Changing" in s.columns:
        out |= {"change_status": M.change_status(s), "top_changing": M.top_changing(s, 15)}
    return out


UNSORTED = {"genre_matrix", "genre_matrix_wide", "genre_flow_nodes", "genre_flow_links", "device_histogram"}


def _same_marts(got, want):
    assert set(got) == set(want)
    for name, df in want.items():
        a, b = [tuple(r) for r in got[name].collect()], [tuple(r) for r in df.collect()]
        if name in UNSORTED:
            a, b = sorted(a, key=str), sorted(b, key=str)
        assert got[name].columns == df.columns and a == b, name
        assert [f.dataType for f in got[name].schema] == [f.dataType for f in df.schema], name


def test_grouping_sets_give_every_mart(spark):
    from viewlens.plans.dashboard import dashboard_marts
    from viewlens.plans.registry import QUERIES
    from viewlens.session import stored
    sf = "/root/testdata/sf0.001"
    r, c, s = (stored(QUERIES[q](spark, sf), "mart-test") for q in ("rfm_segments", "content_profile", "search_changing"))
    got = dashboard_marts(r, c, s)
    got.pop("filter_options")
    _same_marts(got, _one_by_one(r.filter("Segment IS NOT NULL"), c, s))


def test_grouping_sets_with_nulls_and_without_rows(spark):
    from viewlens.operators import mart_sets as G
    r = spark.createDataFrame([(1, 2, 3, 10.25, 5.0, "111", "a"), (None, None, None, None, None, None, None), (2, 1, None, 3.0, 1.0, None, "a"),
                               (3, 1, 1, 7.5, 1.0, "555", None)],
                              "CustomerID long, Recency int, Frequency long, Monetary double, AOV double, RFM_Score string, Segment string")
    c = content_rows(spark, [("1", 1, 5, 0, 0, 0, 0, "x", "t", "High"), (None, None, None, 1, 2, 3, 4, None, None, None),
                             ("3", 9, 0, 0, 0, 0, 7, "x", None, "Low"), ("4", 2, 1, 1, 1, 1, 1, None, "t", "High")])
    s = spark.createDataFrame([("1", "k", "A", "l", "B", "A -> B"), ("2", None, None, "l", "B", None), ("3", "k", "A", "k", "A", "No Change")],
                              "user_id string, Most_Searched_T6 string, Genre_T6 string, Most_Searched_T7 string, Genre_T7 string, Changing string")
    for r_, c_, s_ in ((r, c, s), (r.limit(0), c.limit(0), s.limit(0)), (r, c, s.drop("Changing"))):
        _same_marts(G.rfm_marts(G.rfm_sets(r_)) | G.content_marts(G.content_sets(c_)) | G.search_marts(G.search_sets(s_)), _one_by_one(r_, c_, s_))
