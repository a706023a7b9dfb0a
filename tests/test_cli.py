import datetime as dt
import os

from pyspark.sql import functions as F

from viewlens import cli
from viewlens.sources import sinks
from viewlens.sources import testdata as TD

SF = "/root/testdata/sf0.001"


def test_cli_content_and_rfm(spark, tmpdir_path, capsys):
    src = os.path.join(tmpdir_path, "log")
    sinks.write_content_log(TD.content_log(spark, SF, dt.date(2024, 1, 1), dt.date(2024, 1, 3)), src,
                            layout="daily_files")
    out = os.path.join(tmpdir_path, "content")
    cli.main(["content", "--source", src, "--start", "20240101", "--end", "20240103", "--out", out])
    assert spark.read.parquet(out).count() > 0
    tx_csv = os.path.join(tmpdir_path, "tx")
    sinks.write_csv(TD.transactions(spark, SF), tx_csv)
    out = os.path.join(tmpdir_path, "rfm")
    cli.main(["rfm", "--transactions", tx_csv, "--out", out, "--format", "csv", "--audit"])
    assert spark.read.option("header", True).csv(out).count() > 0
    printed = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("{")]
    assert '"rows_before"' in printed[0] and len(printed) >= 2


def test_cli_search_chain(spark, tmpdir_path):
    log = TD.search_log_tagged(spark, SF)
    for p in (1, 2):
        sinks.write_parquet(log.filter(F.col("period") == p).drop("period"), os.path.join(tmpdir_path, f"log{p}"))
        sinks.write_csv(TD.keyword_mapping(spark, SF, p).withColumn("user_id", F.lit("x"))
                        .withColumn("search_count", F.lit(1)).select("user_id", "keyword", "search_count", "Genre"),
                        os.path.join(tmpdir_path, f"map{p}"))
    top = os.path.join(tmpdir_path, "top")
    cli.main(["top-keywords", "--first", f"{tmpdir_path}/log1", "--second", f"{tmpdir_path}/log2", "--out", top])
    assert spark.read.parquet(f"{top}/first").columns == ["user_id", "keyword", "search_count"]
    assert spark.read.parquet(f"{top}/second").count() > 0
    out = os.path.join(tmpdir_path, "search")
    cli.main(["search", "--first", f"{tmpdir_path}/log1", "--second", f"{tmpdir_path}/log2",
              "--mapping-first", f"{tmpdir_path}/map1", "--mapping-second", f"{tmpdir_path}/map2", "--out", out])
    from viewlens.plans.registry import QUERIES
    want = QUERIES["search_changing"](spark, SF)
    got = spark.read.parquet(out).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_cli_marts_from_stored_tables(spark, tmpdir_path):
    from viewlens.plans.registry import QUERIES
    paths = {}
    for name, q in (("rfm", "rfm_segments"), ("content", "content_profile"), ("search", "search_changing")):
        paths[name] = os.path.join(tmpdir_path, name)
        sinks.write_parquet(QUERIES[q](spark, SF), paths[name])
    out = os.path.join(tmpdir_path, "marts")
    cli.main(["marts", "--rfm", paths["rfm"], "--content", paths["content"], "--search", paths["search"],
              "--segments", "Champions", "Lost", "--change", "changed", "--out", out])
    got = spark.read.parquet(os.path.join(out, "rfm_segment_counts"))
    assert sorted(r.Segment for r in got.collect()) == ["Champions", "Lost"]
    kp = spark.read.parquet(os.path.join(out, "search_kpis")).collect()[0]
    want = QUERIES["search_changing"](spark, SF).filter("Changing IS NULL OR Changing <> 'No Change'").count()
    assert kp.users == want
    assert len(os.listdir(out)) == 30


def test_cli_full_search_chain_through_classify(spark, tmpdir_path):
    """top-keywords (CSV) -> classify (CSV) -> search, as the original scripts chain."""
    log = TD.search_log_tagged(spark, SF)
    for p in (1, 2):
        sinks.write_parquet(log.filter(F.col("period") == p).drop("period"), os.path.join(tmpdir_path, f"log{p}"))
    top = os.path.join(tmpdir_path, "top")
    cli.main(["top-keywords", "--first", f"{tmpdir_path}/log1", "--second", f"{tmpdir_path}/log2",
              "--out", top, "--format", "csv"])
    for p, sub_dir in ((1, "first"), (2, "second")):
        cli.main(["classify", "--input", f"{top}/{sub_dir}", "--out", os.path.join(tmpdir_path, f"map{p}"),
                  "--format", "csv"])
    out = os.path.join(tmpdir_path, "search")
    cli.main(["search", "--first", f"{tmpdir_path}/log1", "--second", f"{tmpdir_path}/log2",
              "--mapping-first", f"{tmpdir_path}/map1", "--mapping-second", f"{tmpdir_path}/map2", "--out", out])
    res = spark.read.parquet(out)
    changing = {r.Changing for r in res.select("Changing").distinct().collect()}
    assert "No Change" in changing and any(" -> " in c for c in changing)


def test_read_mapping_accepts_both_layouts(spark, tmpdir_path):
    from viewlens.sources import files
    a = os.path.join(tmpdir_path, "a.csv")
    with open(a, "w", encoding="utf-8-sig") as f:
        f.write("user_id,keyword,search_count,Genre\n1,k1,3,Drama\n")
    b = os.path.join(tmpdir_path, "b.csv")
    with open(b, "w", encoding="utf-8") as f:
        f.write("keyword,genre\nk2,News\n")
    assert [tuple(r) for r in files.read_mapping(spark, a).collect()] == [("k1", "Drama")]
    assert [tuple(r) for r in files.read_mapping(spark, b).collect()] == [("k2", "News")]


def test_cli_stream_content(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "log")
    flat = TD.content_log(spark, SF, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    sinks.write_content_log(flat, src, layout="daily_files")
    sink, ckpt = os.path.join(tmpdir_path, "daily"), os.path.join(tmpdir_path, "ckpt")
    cli.main(["stream-content", "--source", src, "--sink", sink, "--checkpoint", ckpt])
    from viewlens.plans.content import content_daily
    got = spark.read.parquet(sink).drop("day")
    want = content_daily(flat)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_cli_classify_with_plugged_labeller(spark, tmpdir_path):
    top = os.path.join(tmpdir_path, "top")
    sinks.write_csv(spark.createDataFrame([("1", "red bolt", 3), ("2", "blue ring", 1), ("3", "x gear", 2)],
                                          "user_id string, keyword string, search_count long"), top)
    out = os.path.join(tmpdir_path, "labels")
    cli.main(["classify", "--input", top, "--labeller", "helpers.fake_labeller:label", "--batch-size", "2",
              "--out", out])
    got = {r.keyword: r.Genre for r in spark.read.parquet(out).collect()}
    assert got == {"red bolt": "Action", "blue ring": "Romance", "x gear": "Comedy"}


def test_cli_classify_incremental(spark, tmpdir_path):
    top = os.path.join(tmpdir_path, "top")
    sinks.write_csv(spark.createDataFrame([("1", "red bolt", 3), ("2", "blue ring", 1)],
                                          "user_id string, keyword string, search_count long"), top)
    known = os.path.join(tmpdir_path, "known")
    sinks.write_csv(spark.createDataFrame([("red bolt", "Horror")], "keyword string, Genre string"), known)
    out = os.path.join(tmpdir_path, "labels")
    cli.main(["classify", "--input", top, "--known", known, "--labeller", "helpers.fake_labeller:label",
              "--out", out])
    got = {r.keyword: r.Genre for r in spark.read.parquet(out).collect()}
    assert got == {"red bolt": "Horror", "blue ring": "Romance"}


def test_cli_content_from_daily_table(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "log")
    flat = TD.content_log(spark, SF, dt.date(2024, 1, 1), dt.date(2024, 1, 6))
    sinks.write_content_log(flat, src, layout="daily_files")
    daily = os.path.join(tmpdir_path, "daily")
    cli.main(["stream-content", "--source", src, "--sink", daily, "--checkpoint", os.path.join(tmpdir_path, "c")])
    a, b = os.path.join(tmpdir_path, "a"), os.path.join(tmpdir_path, "b")
    cli.main(["content", "--source", daily, "--from-daily", "--start", "20240102", "--end", "20240105", "--out", a])
    cli.main(["content", "--source", src, "--start", "20240102", "--end", "20240105", "--out", b])
    assert sorted(map(tuple, spark.read.parquet(a).collect())) == sorted(map(tuple, spark.read.parquet(b).collect()))


def test_cli_marts_from_csv_tables(spark, tmpdir_path):
    from viewlens.operators import marts as M
    from viewlens.plans.registry import QUERIES
    paths = {}
    for name, q in (("rfm", "rfm_segments"), ("content", "content_profile"), ("search", "search_changing")):
        paths[name] = os.path.join(tmpdir_path, name)
        df = QUERIES[q](spark, SF)
        sinks.write_csv(df.select(*reversed(df.columns)), paths[name])  # column order must not matter
    out = os.path.join(tmpdir_path, "marts")
    cli.main(["marts", "--input-format", "csv", "--rfm", paths["rfm"], "--content", paths["content"],
              "--search", paths["search"], "--out", out])
    got = spark.read.parquet(os.path.join(out, "rfm_segment_stats"))
    want = M.rfm_segment_stats(QUERIES["rfm_segments"](spark, SF))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_cli_top_keywords_report_and_missing_out(spark, tmpdir_path, capsys):
    import pytest
    log = os.path.join(tmpdir_path, "log")
    sinks.write_parquet(spark.createDataFrame([("u", "a"), ("v", "a"), ("w", "b")], "user_id string, keyword string"), log)
    cli.main(["top-keywords", "--first", log, "--second", log, "--out", f"{tmpdir_path}/top", "--report", "1"])
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("{")]
    assert lines == ['{"distinct_keywords": 2}', '{"period": 1, "keyword": "a", "count": 2}', '{"period": 2, "keyword": "a", "count": 2}']
    with pytest.raises(SystemExit):
        cli.main(["top-keywords", "--first", log, "--second", log])


DERBY = ["--driver", "org.apache.derby.jdbc.EmbeddedDriver"]


def test_cli_top_keywords_to_one_jdbc_table(spark, tmpdir_path):
    """Derby inside the test process."""
    log, url = os.path.join(tmpdir_path, "log"), "jdbc:derby:memory:viewlens_top;create=true"
    sinks.write_parquet(spark.createDataFrame([("u", "a")], "user_id string, keyword string"), log)
    cli.main(["top-keywords", "--first", log, "--second", log, "--format", "jdbc", "--jdbc-url", url, "--table", "TOPK", *DERBY])
    got = sinks.read_jdbc(spark, url, "TOPK", driver=DERBY[1])
    assert sorted(r.period for r in got.collect()) == [1, 2]


def test_cli_marts_from_jdbc_without_changing(spark, tmpdir_path):
    from viewlens.plans.registry import QUERIES
    url = "jdbc:derby:memory:viewlens_marts;create=true"
    table = QUERIES["search_changing"](spark, SF).drop("Changing")
    sinks.write_jdbc(table, url, "SEARCH_STATS", mode="overwrite", driver=DERBY[1])
    out = os.path.join(tmpdir_path, "marts")
    cli.main(["marts", "--input-format", "jdbc", "--jdbc-url", url, "--search", "SEARCH_STATS", "--out", out, *DERBY])
    assert spark.read.parquet(f"{out}/search_kpis").columns == ["users", "genres_t6", "genres_t7"]
    assert not os.path.exists(f"{out}/change_status")


def test_cli_classify_overrides_with_a_labeller_and_known(spark, tmpdir_path):
    top = os.path.join(tmpdir_path, "top")
    sinks.write_csv(spark.createDataFrame([("1", "red bolt", 3), ("2", "blue ring", 1), ("3", "x gear", 2)],
                                          "user_id string, keyword string, search_count long"), top)
    paths = {n: os.path.join(tmpdir_path, n) for n in ("known", "over", "a", "b")}
    sinks.write_csv(spark.createDataFrame([("red bolt", "Horror")], "keyword string, Genre string"), paths["known"])
    sinks.write_csv(spark.createDataFrame([("blue ring", "News")], "keyword string, Genre string"), paths["over"])
    run = ["classify", "--input", top, "--labeller", "helpers.fake_labeller:label", "--overrides", paths["over"], "--partitions", "3"]
    cli.main([*run, "--out", paths["a"]])
    assert {r.keyword: r.Genre for r in spark.read.parquet(paths["a"]).collect()} == {"red bolt": "Action", "blue ring": "News", "x gear": "Comedy"}
    cli.main([*run, "--known", paths["known"], "--out", paths["b"]])
    assert {r.keyword: r.Genre for r in spark.read.parquet(paths["b"]).collect()} == {"red bolt": "Horror", "blue ring": "News", "x gear": "Comedy"}
