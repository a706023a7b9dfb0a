from viewlens import schemas as S
from viewlens.operators import classify as K


def test_examples_and_hints(spark):
    words = list(S.GENRE_EXAMPLES) + ["HTV7 live", "Love in the rain", "harry potter 3", "nothing"]
    df = spark.createDataFrame([(w,) for w in words], "keyword string")
    got = {r.keyword: r.Genre for r in K.classify_rules(df).collect()}
    for k, g in S.GENRE_EXAMPLES.items():
        assert got[k] == g
    assert got["HTV7 live"] == "TV Channel" and got["Love in the rain"] == "Romance"
    assert got["harry potter 3"] == "Drama" and got["nothing"] == "Other"


def test_override_table_wins_and_is_validated(spark):
    df = spark.createDataFrame([("running",), ("zzz",), ("bad",)], "keyword string")
    ov = spark.createDataFrame([("running", "Comedy"), ("bad", "NotAGenre")], "keyword string, Genre string")
    got = {r.keyword: r.Genre for r in K.classify_rules(df, ov).collect()}
    assert got == {"running": "Comedy", "zzz": "Other", "bad": "Other"}


def test_response_parse(spark):
    rows = [("ok {\"a\":\"Drama\"} z", ["a", "b"]), ("none", ["c"]), ("{bad", ["d"]),
            ("x {\"e\": \"Weird\"} y", ["e"])]
    df = spark.createDataFrame(rows, "response string, keywords array<string>")
    got = {r.keyword: r.Genre for r in K.parse_responses(df).collect()}
    assert got == {"a": "Drama", "b": "Other", "c": "Other", "d": "Other", "e": "Other"}


def test_batched_labeller_and_failures(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(250)] + [("boom",)], "keyword string")

    def labeller(words):
        if "boom" in words:
            raise RuntimeError("service down")
        return {w: "Drama" for w in words}

    got = {r.keyword: r.Genre for r in K.classify_batched(df, labeller, batch_size=40, num_partitions=4).collect()}
    assert len(got) == 251 and got["boom"] == "Other"
    assert sum(1 for g in got.values() if g == "Drama") >= 250 - 40


def test_answers_that_are_not_one_object(spark):
    rows = [('{"a":"Horror","a":"Drama"}', "a", "Drama"), ("{'b':'Drama'}", "b", "Other"), ('{"c":"Drama"} {"c":"Drama"}', "c", "Other"),
            ('x {"d":"Drama"} y } z', "d", "Other"), ('{"e":"Drama",}', "e", "Other"), ('{"f":null}', "f", "Other"), (None, "g", "Other")]
    df = spark.createDataFrame([(r, [k]) for r, k, _ in rows], "response string, keywords array<string>")
    assert {r.keyword: r.Genre for r in K.parse_responses(df).collect()} == {k: g for _, k, g in rows}


def test_names_and_film_origin(spark):
    names = spark.createDataFrame([("France", "Sports"), ("ASIA", "News")], "name string, Genre string")
    words = {"FRANCE": "Sports", "asia": "News", "phim hàn hay": "K Drama", "Phim Trung": "C Drama", "france tv": "Other"}
    df = spark.createDataFrame([(w,) for w in words], "keyword string")
    assert {r.keyword: r.Genre for r in K.classify_rules(df, names=names).collect()} == words


def test_failed_keywords_are_left_out_and_asked_again(spark):
    def down(words):
        raise RuntimeError("service down")

    kw = spark.createDataFrame([("a",), ("b",), ("c",)], "keyword string")
    known = spark.createDataFrame([("a", "Drama")], "keyword string, Genre string")
    failures = spark.sparkContext.accumulator(0)
    first = K.classify_incremental(kw, known, down, failures=failures)
    assert [tuple(r) for r in first.collect()] == [("a", "Drama")] and failures.value == 2
    second = K.classify_incremental(kw, first, lambda words: ["News"] * len(words))
    assert {r.keyword: r.Genre for r in second.collect()} == {"a": "Drama", "b": "News", "c": "News"}


def test_labeller_calls_run_in_many_tasks(spark):
    df = spark.range(10_000).selectExpr("concat('k', id) AS keyword")
    out = K.classify_batched(df, lambda words: ["News"] * len(words), num_partitions=6)
    assert out.rdd.getNumPartitions() == 6 and out.count() == 10_000


def test_workers_do_not_need_the_package(tmp_path):
    """A session in another folder, with the package on the driver's path only."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.range(1).mapInPandas(lambda it: it, "id long").collect()  # the workers start without the package
sys.path.insert(0, {root!r})
from viewlens.operators import classify as K
df = spark.createDataFrame([("VTV1",), ("x",)], "keyword string")
print(sorted(map(tuple, K.classify_batched(df, K.rules_labeller()).collect())))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "[('VTV1', 'TV Channel'), ('x', 'Other')]" in out.stdout, out.stderr[-2000:]


def test_batched_rules_equal_column_rules(spark):
    words = list(S.GENRE_EXAMPLES) + ["VTV1", "reality tv", "abc"]
    df = spark.createDataFrame([(w,) for w in words], "keyword string")
    a = {r.keyword: r.Genre for r in K.classify_rules(df).collect()}
    b = {r.keyword: r.Genre for r in K.classify_batched(df, K.rules_labeller(), batch_size=3).collect()}
    assert a == b


def test_incremental_labels_only_new_keywords(spark):
    calls = spark.sparkContext.accumulator(0)

    def labeller(words):
        calls.add(len(words))
        return ["News"] * len(words)

    kw = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "keyword string")
    known = spark.createDataFrame([("a", "Drama"), ("z", "Action")], "keyword string, Genre string")
    got = {r.keyword: r.Genre for r in K.classify_incremental(kw, known, labeller, batch_size=10).collect()}
    assert got == {"a": "Drama", "b": "News", "c": "News"}
    assert calls.value == 2
