"""Stored states that days are added to: distinct devices as bitmaps, search counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from viewlens.operators import devices as D
from viewlens.operators import search as Q
from viewlens.operators import classify as K
from viewlens.plans import devices, search_state
from viewlens.plans.content import content_daily
from viewlens.plans.refresh import listing, refresh_daily
from viewlens.plans.search import search_change
from viewlens.plans.search_tables import change_from_tables, save_search_tables
from viewlens.streaming.content_daily import read_daily_profiles
from viewlens.sources import files, sinks
from viewlens.sources import testdata as TD
from viewlens.streaming.search_daily import start_daily_counts

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


def views(spark, rows):
    return spark.createDataFrame([(c, m, DAY + dt.timedelta(days=d)) for c, m, d in rows], "Contract string, Mac string, Process_Date date")


def plain(rows, lo=0, hi=99):
    out = {}
    for c, m, d in rows:
        if lo <= d <= hi:
            out.setdefault(c, set()).update([m] if m is not None else [])
    return {c: len(m) for c, m in out.items()}


def got(df):
    return {r.Contract: r.Distinct_Devices for r in df.collect()}


def test_devices_of_any_days(spark, tmpdir_path):
    rnd = random.Random(1)
    rows = [(rnd.choice("ABCD"), rnd.choice([None, *(f"m{i}" for i in range(40))]), rnd.randrange(6)) for _ in range(600)]
    rows += [("only null", None, 2), ("big", "x", 0)]
    for day in range(6):  # one day after the other
        devices.add_days(views(spark, [r for r in rows if r[2] == day]), tmpdir_path)
    for lo, hi in ((0, 5), (1, 3), (2, 2), (4, 9)):
        out = devices.distinct_devices(spark, tmpdir_path, DAY + dt.timedelta(days=lo), DAY + dt.timedelta(days=hi))
        assert got(out) == plain(rows, lo, hi)
    before = sorted(map(str, spark.read.parquet(f"{tmpdir_path}/days").collect()))
    n = spark.read.parquet(f"{tmpdir_path}/devices").count()
    devices.add_days(views(spark, [r for r in rows if r[2] in (1, 4)]), tmpdir_path)  # fed again: nothing changes
    assert sorted(map(str, spark.read.parquet(f"{tmpdir_path}/days").collect())) == before
    assert spark.read.parquet(f"{tmpdir_path}/devices").count() == n
    devices.add_days(views(spark, [("A", "late", 3)]), tmpdir_path)  # a day is replaced as a whole
    assert got(devices.distinct_devices(spark, tmpdir_path, DAY + dt.timedelta(days=3), DAY + dt.timedelta(days=3))) == {"A": 1}
    assert devices.days(spark, tmpdir_path).count() == 6


def test_numbers_are_dense_and_never_change(spark):
    rows = [("A", f"m{i}", 0) for i in range(500)] + [("B", "m1", 0), (None, "m", 0), ("A", None, 0)]
    first = D.new_devices(views(spark, rows)).collect()
    assert sorted(r.Device for r in first if r.Contract == "A") == list(range(1, 501))
    assert [(r.Contract, r.Device) for r in first if r.Contract != "A"] == [("B", 1)]
    known = spark.createDataFrame(first, "Contract string, Mac string, Device long")
    more = D.new_devices(views(spark, [*rows, ("A", "new", 1), ("A", "newer", 1), ("C", "new", 1)]), known).collect()
    assert sorted((r.Contract, r.Device) for r in more) == [("A", 501), ("A", 502), ("C", 1)]


def test_more_devices_than_a_bitmap_holds(spark, tmpdir_path):
    many = spark.range(70_000).select(F.lit("hot").alias("Contract"), F.col("id").cast("string").alias("Mac"), F.lit(DAY).alias("Process_Date"))
    devices.add_days(many, tmpdir_path)
    assert got(devices.distinct_devices(spark, tmpdir_path)) == {"hot": 70_000}
    state = spark.read.parquet(f"{tmpdir_path}/days")
    assert state.count() == 3 and state.agg(F.max(F.length("devices"))).first()[0] == 4096


def test_the_range_is_pruned_and_no_log_is_read(spark, tmpdir_path):
    devices.add_days(views(spark, [("A", "m", 0), ("A", "n", 1)]), tmpdir_path)
    out = devices.distinct_devices(spark, tmpdir_path, DAY, DAY)
    assert "PartitionFilters: [isnotnull(Process_Date" in out._jdf.queryExecution().executedPlan().toString()
    assert all("/days/Process_Date=2024-01-01/" in f for f in out.inputFiles()) or len(out.inputFiles()) >= 1


def pairs(df):
    return sorted(map(tuple, df.select("period", "user_id", "keyword", "search_count").collect()))


def test_days_fed_one_by_one_and_again(spark, tmpdir_path):
    log = TD.search_log_days(spark, SF).filter(F.dayofmonth("day") <= 4).persist()
    days = [r.day for r in log.select("day").distinct().collect()]
    for day in days:
        search_state.add_days(log.filter(F.col("day") == F.lit(day)), tmpdir_path)
    tagged = log.select(F.when(F.month("day") == 6, 1).otherwise(2).alias("period"), "user_id", "keyword")
    want = pairs(Q.top_keyword(tagged))
    assert pairs(search_state.top_keyword(spark, tmpdir_path, TD.SEARCH_MONTHS)) == want
    for day in days[:2]:
        search_state.add_days(log.filter(F.col("day") == F.lit(day)), tmpdir_path)
    assert pairs(search_state.top_keyword(spark, tmpdir_path, TD.SEARCH_MONTHS)) == want
    one = {1: (days[0], days[0])}
    assert pairs(search_state.top_keyword(spark, tmpdir_path, one)) == pairs(Q.top_keyword(log.filter(F.col("day") == F.lit(days[0])).select(F.lit(1).alias("period"), "user_id", "keyword")))
    with pytest.raises(ValueError, match="overlap"):
        search_state.top_keyword(spark, tmpdir_path, {1: (DAY, DAY), 2: (DAY, DAY)})


def test_streamed_days_late_files_and_null_keywords(spark, tmpdir_path):
    src, state, ckpt = f"{tmpdir_path}/src", f"{tmpdir_path}/state", f"{tmpdir_path}/ckpt"

    def arrive(rows, mode="append"):
        df = spark.createDataFrame(rows, "day string, user_id string, keyword string")
        df.write.mode(mode).partitionBy("day").parquet(src)
        start_daily_counts(spark, src, state, ckpt).awaitTermination()

    arrive([("20220601", "u", "a"), ("20220601", "u", "b"), ("20220601", "v", None), ("20220702", "u", "c")])
    months = TD.SEARCH_MONTHS
    assert pairs(search_state.top_keyword(spark, state, months)) == [(1, "u", "a", 1), (2, "u", "c", 1)]
    arrive([("20220601", "u", "b"), ("20220603", "v", "z")])  # a late file of the first day
    assert pairs(search_state.top_keyword(spark, state, months)) == [(1, "u", "b", 2), (1, "v", "z", 1), (2, "u", "c", 1)]
    start_daily_counts(spark, src, state, ckpt).awaitTermination()  # nothing new
    assert search_state.read(spark, state).agg(F.sum("search_count")).first()[0] == 5


def test_search_days_by_folder(spark, tmpdir_path):
    df = spark.createDataFrame([("20220601", "u", "a", 1)], "day string, user_id string, keyword string, other int")
    sinks.write_parquet(df, tmpdir_path, partition_by=["day"])
    out = files.search_days(spark, tmpdir_path, [dt.date(2022, 6, 1), dt.date(2022, 6, 2)])
    assert [tuple(r) for r in out.collect()] == [(dt.date(2022, 6, 1), "u", "a")]
    with pytest.raises(FileNotFoundError):
        files.search_days(spark, tmpdir_path, [dt.date(2022, 7, 1)])


def test_only_new_and_changed_files_are_read_again(spark, tmpdir_path):
    src, sink, ledger = (f"{tmpdir_path}/{x}" for x in ("src", "sink", "ledger"))
    flat = TD.content_log(spark, SF, dt.date(2024, 1, 1), dt.date(2024, 1, 4)).persist()

    def day(i):
        return flat.filter(F.col("Process_Date") == F.lit(dt.date(2024, 1, i)))

    def check(want):
        want = content_daily(want)
        assert sorted(map(tuple, read_daily_profiles(spark, sink).select(want.columns).collect())) == sorted(map(tuple, want.collect()))

    sinks.write_content_log(day(1).unionByName(day(2)), src, mode="append")
    assert refresh_daily(spark, src, sink, ledger, "partitioned") == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    before = {r.path: r.modified for r in listing(spark, sink.replace("sink", "src"), "partitioned").collect()}
    assert refresh_daily(spark, src, sink, ledger, "partitioned") == [] and before
    sinks.write_content_log(day(3), src, mode="append")
    late = spark.createDataFrame([("999", "late", "KPLUS", 7, dt.date(2024, 1, 1))], flat.schema)
    sinks.write_content_log(late, src, mode="append")
    assert refresh_daily(spark, src, sink, ledger, "partitioned") == [dt.date(2024, 1, 1), dt.date(2024, 1, 3)]
    check(day(1).unionByName(late).unionByName(day(2)).unionByName(day(3)))
    path = spark._jvm.org.apache.hadoop.fs.Path
    path(src).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(f"{src}/day=20240102"), True)
    assert refresh_daily(spark, src, sink, ledger, "partitioned") == [dt.date(2024, 1, 2)]  # a day that is gone
    check(day(1).unionByName(late).unionByName(day(3)))
    sinks.write_content_log(late.withColumn("AppName", F.lit("no such app")).withColumn("Process_Date", F.lit(dt.date(2024, 1, 9))), src, mode="append")
    assert refresh_daily(spark, src, sink, ledger, "partitioned") == [dt.date(2024, 1, 9)]  # a day without a valid view
    check(day(1).unionByName(late).unionByName(day(3)))


def test_bucketed_join_moves_no_keyword(spark, tmpdir_path):
    log, mapping = TD.search_log_tagged(spark, SF), TD.keyword_mapping_tagged(spark, SF)
    save_search_tables(log, mapping, "t_top", "t_genres", tmpdir_path, buckets=4)
    want = sorted(map(tuple, search_change(log, mapping).collect()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = change_from_tables(spark, "t_top", "t_genres")
        assert sorted(map(tuple, out.collect())) == want
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin [keyword" in plan and "hashpartitioning(keyword" not in plan and "BroadcastExchange" not in plan
    spark.sql("DROP TABLE t_top")
    spark.sql("DROP TABLE t_genres")


def test_a_labeller_that_dies_is_asked_for_the_rest_only(spark, tmpdir_path):
    asked, ledger = f"{tmpdir_path}/asked", f"{tmpdir_path}/labels"
    words = [f"w{i:03d}" for i in range(95)] + [None]
    kw = spark.createDataFrame([(w,) for w in words * 2], "keyword string").repartition(3)

    def labeller(deadly):
        def label(batch):
            with open(asked, "a") as f:  # the calls, seen from outside the tasks
                f.write("\n".join(batch) + "\n")
            if any(w in deadly for w in batch):
                raise RuntimeError("the service is gone")
            return {w: "Music" if w < "w050" else "not a genre" for w in batch}
        return label

    with pytest.raises(Exception, match="service is gone"):
        K.classify_resumable(kw, labeller({"w007", "w070"}), ledger, batch_size=10)
    done = {r.keyword for r in K.answered(spark, ledger).collect()}
    assert 0 < len(done) < 95 and not done & {"w007", "w070"}
    open(asked, "w").close()
    out = {r.keyword: r.Genre for r in K.classify_resumable(kw, labeller(set()), ledger, batch_size=10).collect()}
    assert out == {w: "Music" if w < "w050" else "Other" for w in words if w}
    with open(asked) as f:
        again = f.read().split()
    assert sorted(again) == sorted(set(words) - done - {None})  # each once, and none of the answered ones
    part = K.classify_resumable(kw.filter("keyword < 'w003'"), labeller({"w001"}), ledger, batch_size=10)
    assert part.count() == 3  # nobody is asked
