import datetime as dt

from pyspark.sql import functions as F

from viewlens.plans.content import content_daily
from viewlens.sources import sinks
from viewlens.sources import testdata as TD
from viewlens.streaming.content_daily import profile_from_daily, read_daily_profiles, start_daily_profiles

SF = "/root/testdata/sf0.001"


def test_incremental_days_and_late_file(spark, tmpdir_path):
    src, sink, ckpt = f"{tmpdir_path}/src", f"{tmpdir_path}/sink", f"{tmpdir_path}/ckpt"
    flat = TD.content_log(spark, SF, dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    d = F.col("Process_Date")
    first = flat.filter(d <= F.lit(dt.date(2024, 1, 2)))
    sinks.write_content_log(first, src, layout="partitioned", mode="append")
    start_daily_profiles(spark, src, sink, ckpt, layout="partitioned").awaitTermination()
    assert read_daily_profiles(spark, sink).select("Process_Date").distinct().count() == 2
    # days 3-4 arrive, plus a second file for day 2
    sinks.write_content_log(flat.filter(d > F.lit(dt.date(2024, 1, 2))), src, layout="partitioned", mode="append")
    late = spark.createDataFrame([("999", "late-mac", "KPLUS", 123, dt.date(2024, 1, 2))], flat.schema)
    sinks.write_content_log(late, src, layout="partitioned", mode="append")
    start_daily_profiles(spark, src, sink, ckpt, layout="partitioned").awaitTermination()
    got = read_daily_profiles(spark, sink)
    want = content_daily(flat.unionByName(late))
    cols = want.columns
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.collect()))
    prof = profile_from_daily(spark, sink)
    assert prof.filter("Contract = '999'").collect()[0].Total_Truyen_Hinh == 123


def test_daily_files_layout(spark, tmpdir_path):
    src, sink, ckpt = f"{tmpdir_path}/src", f"{tmpdir_path}/sink", f"{tmpdir_path}/ckpt"
    flat = TD.content_log(spark, SF, dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    sinks.write_content_log(flat, src, layout="daily_files")
    start_daily_profiles(spark, src, sink, ckpt, layout="daily_files").awaitTermination()
    got = read_daily_profiles(spark, sink)
    want = content_daily(flat)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
