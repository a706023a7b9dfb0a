from pyspark.sql import functions as F

from viewlens.operators import search as Q
from viewlens.plans.search import search_change, search_change_stepwise, tagged_log
from viewlens.sources import testdata as TD

LOG = "period int, user_id string, keyword string"
MAP = "period int, keyword string, Genre string"


def test_top_keyword_nulls_and_ties(spark):
    data = [(1, "1", None), (1, "1", None), (1, "1", "a"), (1, "2", None), (1, "3", "b"), (1, "3", "a")]
    got = {r.user_id: r.keyword for r in Q.top_keyword(spark.createDataFrame(data, LOG)).collect()}
    assert got == {"1": "a", "3": "a"}


def test_both_months_required_and_change_labels(spark):
    log = spark.createDataFrame([(1, "u1", "x"), (2, "u1", "y"), (1, "u2", "x"), (2, "u3", "x"),
                                 (1, "u4", "x"), (2, "u4", "x")], LOG)
    mapping = spark.createDataFrame([(1, "x", "Drama"), (2, "x", "Drama"), (2, "y", "Music")], MAP)
    got = {r.user_id: r.Changing for r in search_change(log, mapping).collect()}
    assert got == {"u1": "Drama -> Music", "u4": "No Change"}


def test_genre_conflict_earliest_period(spark):
    mapping = spark.createDataFrame([(2, "k", "Other"), (1, "k", "Drama"), (1, "k", "Action")], MAP)
    assert Q.genre_dimension(mapping).collect()[0].Genre == "Action"
    mapping = spark.createDataFrame([(2, "k", "Other"), (1, "k", "Drama")], MAP)
    assert Q.genre_dimension(mapping).collect()[0].Genre == "Drama"


def test_null_genre_gives_null_label(spark):
    from viewlens.functions.labels import change_label
    df = spark.createDataFrame([("X", "X"), ("X", "Y"), ("X", None)], "a string, b string")
    got = [r.c for r in df.select(change_label(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got == ["No Change", "X -> Y", None]


def test_keyword_only_labelled_in_other_period_is_dropped(spark):
    log = spark.createDataFrame([(1, "u", "old"), (2, "u", "x")], LOG)
    mapping = spark.createDataFrame([(2, "old", "Drama"), (1, "x", "Drama"), (2, "x", "Drama")], MAP)
    assert search_change(log, mapping).count() == 0


def test_fused_equals_stepwise(spark):
    log, mapping = TD.search_log_tagged(spark, "/root/testdata/sf0.001"), TD.keyword_mapping_tagged(
        spark, "/root/testdata/sf0.001")
    a = sorted(map(tuple, search_change(log, mapping).collect()))
    b = sorted(map(tuple, search_change_stepwise(log, mapping).collect()))
    assert a == b and len(a) > 0


def test_tagged_log_from_two_logs(spark):
    a = spark.createDataFrame([("u", "k")], "user_id string, keyword string")
    out = tagged_log(a, a).collect()
    assert sorted(r.period for r in out) == [1, 2]


def test_normalize_headers_and_trim(spark):
    df = spark.createDataFrame([("1", " a ", "G ", " b", "H", " No Change ")],
                               "user_id string, most_searched_t6 string, genre_t6 string, most_searched_t7 string, "
                               "genre_t7 string, changing string")
    r = Q.normalize(df).collect()[0]
    assert r.Most_Searched_T6 == "a" and r.Changing == "No Change" and r.Genre_T6 == "G"


def test_salted_join_equals_plain_with_one_hot_key(spark):
    from viewlens.operators.joins import salted_join
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(3000)], "id long, keyword string")
    small = spark.createDataFrame([("hot", "Drama")] + [(f"k{i}", "News") for i in range(7)], "keyword string, Genre string")
    for how in ("inner", "left"):
        a = sorted(map(tuple, big.join(small, "keyword", how).select("id", "keyword", "Genre").collect()))
        b = sorted(map(tuple, salted_join(big, small, ["keyword"], 8, how).select("id", "keyword", "Genre").collect()))
        assert a == b
    # the hot key's rows are spread over all salt values
    salts = big.filter("keyword = 'hot'").select(F.pmod(F.xxhash64("id", "keyword"), F.lit(8)).alias("s")).distinct()
    assert salts.count() == 8


def test_salted_change_table_equals_plain(spark):
    log, mapping = TD.search_log_tagged(spark, "/root/testdata/sf0.001"), TD.keyword_mapping_tagged(
        spark, "/root/testdata/sf0.001")
    a = sorted(map(tuple, search_change(log, mapping).collect()))
    b = sorted(map(tuple, search_change(log, mapping, salt_buckets=8).collect()))
    assert a == b
