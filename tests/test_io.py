import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.sources import files, sinks
from viewlens.sources import testdata as TD

SF = "/root/testdata/sf0.001"


def test_json_daily_files_range_scan_skips_missing_days(spark, tmpdir_path):
    flat = TD.content_log(spark, SF, dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    flat = flat.filter(F.col("Process_Date") != F.lit(dt.date(2024, 1, 3)))
    sinks.write_content_log(flat, tmpdir_path, layout="daily_files")
    assert sorted(os.listdir(tmpdir_path)) == ["20240101.json", "20240102.json", "20240104.json"]
    got = files.content_range_scan(spark, tmpdir_path, dt.date(2024, 1, 2), dt.date(2024, 1, 10))
    want = flat.filter(F.col("Process_Date") >= F.lit(dt.date(2024, 1, 2)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    for base, start in ((tmpdir_path, dt.date(2025, 1, 1)), (tmpdir_path + "/nowhere", dt.date(2024, 1, 2))):
        with pytest.raises(FileNotFoundError):
            files.content_range_scan(spark, base, start, start)
    sinks.write_content_log(flat.limit(3), tmpdir_path, layout="daily_files", mode="append")
    assert not any(f.startswith("_") for f in os.listdir(tmpdir_path))
    again = files.content_range_scan(spark, tmpdir_path, dt.date(2024, 1, 1), dt.date(2024, 1, 10))
    assert again.count() == flat.count() + 3


def test_raw_json_extra_fields_ignored(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "20240105.json")
    with open(path, "w") as f:
        f.write('{"_index":"x","_source":{"Contract":"A","Mac":"m","AppName":"VOD","TotalDuration":7,"Extra":1}}\n')
    got = files.content_range_scan(spark, tmpdir_path, dt.date(2024, 1, 5), dt.date(2024, 1, 5)).collect()
    assert [tuple(r) for r in got] == [("A", "m", "VOD", 7, dt.date(2024, 1, 5))]


def test_csv_transactions_round_trip_with_bom(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "tx.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("Transaction_ID,CustomerID,Purchase_Date,GMV\n1,5,2024-01-02,10.50\n2,0,2024-01-03,3\n")
    got = files.read_transactions(spark, path).collect()
    assert [tuple(r) for r in got] == [("1", 5, dt.date(2024, 1, 2), Decimal("10.50")),
                                       ("2", 0, dt.date(2024, 1, 3), Decimal("3.00"))]
    out = os.path.join(tmpdir_path, "out")
    tx = TD.transactions(spark, SF)
    sinks.write_csv(tx, out)
    back = files.read_transactions(spark, out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, tx.collect()))


def _tx_file(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_transactions_by_header_name(spark, tmpdir_path):
    path = _tx_file(os.path.join(tmpdir_path, "a.csv"), "gmv,Extra,CustomerID,Transaction_ID,Purchase_Date\n1.5,x,7,t1,2024-01-02\n,x,,t2,\n")
    got = files.read_transactions(spark, path).collect()
    assert [tuple(r) for r in got] == [("t1", 7, dt.date(2024, 1, 2), Decimal("1.50")), ("t2", None, None, None)]


@pytest.mark.parametrize("row", ["t1,7,1/2/2024,1.5", "t1,seven,2024-01-02,1.5", "t1,7,2024-01-02,much"])
def test_transactions_that_do_not_parse_raise(spark, tmpdir_path, row):
    path = _tx_file(os.path.join(tmpdir_path, "a.csv"), f"Transaction_ID,CustomerID,Purchase_Date,GMV\n{row}\n")
    with pytest.raises(Exception, match="does not parse"):
        files.read_transactions(spark, path).collect()


def test_transactions_without_a_column_raise(spark, tmpdir_path):
    path = _tx_file(os.path.join(tmpdir_path, "a.csv"), "Transaction_ID,CustomerID,GMV\nt,1,2\n")
    with pytest.raises(ValueError, match="Purchase_Date"):
        files.read_transactions(spark, path)


def test_checkpoint_folder_and_scratch(spark, monkeypatch):
    from viewlens import session
    assert session.is_local("local") and session.is_local("local[4]") and not session.is_local("local-cluster[2,1,512]")

    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
    monkeypatch.setattr(session, "_made", [])
    path = session.scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    session.remove_scratch()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_mapping_csv(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "m.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("user_id,keyword,search_count,Genre\n1,running man,3,Reality Show\n")
    assert [tuple(r) for r in files.read_mapping(spark, path).collect()] == [("running man", "Reality Show")]


def test_parquet_partition_pruning(spark, tmpdir_path):
    sinks.write_parquet(TD.search_log_tagged(spark, SF), tmpdir_path, partition_by=["period"])
    df = files.read_search_log(spark, tmpdir_path, period=2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "= 2)" in plan
    assert df.count() == TD.search_log_tagged(spark, SF).filter("period = 2").count()


def test_jdbc_round_trip_embedded_derby(spark):
    url = "jdbc:derby:memory:viewlens_test;create=true"
    df = spark.createDataFrame([("A", 1), ("B", 2)], "Contract string, n int")
    sinks.write_jdbc(df, url, "RESULTS", mode="overwrite", driver="org.apache.derby.jdbc.EmbeddedDriver")
    sinks.write_jdbc(df, url, "RESULTS", mode="append", driver="org.apache.derby.jdbc.EmbeddedDriver")
    back = sinks.read_jdbc(spark, url, "RESULTS", driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert back.count() == 4
    sinks.write_jdbc(df, url, "RESULTS", mode="overwrite", driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert sinks.read_jdbc(spark, url, "RESULTS", driver="org.apache.derby.jdbc.EmbeddedDriver").count() == 2


def test_load_table_parquet_and_catalog(spark, tmpdir_path):
    df = spark.createDataFrame([("A", 1)], "Contract string, n int")
    sinks.write_parquet(df, tmpdir_path)
    assert sinks.load_table(spark, tmpdir_path).count() == 1
    df.createOrReplaceTempView("viewlens_tmp_table")
    assert sinks.load_table(spark, "viewlens_tmp_table", fmt="table").count() == 1


def test_search_log_month_glob(spark, tmpdir_path):
    df = spark.createDataFrame([("u1", "a"), ("u2", None)], "user_id string, keyword string")
    for day in ("20220601", "20220630", "20220701"):
        sinks.write_parquet(df.withColumn("extra", F.lit(day)), os.path.join(tmpdir_path, day))
    june = files.read_search_log(spark, os.path.join(tmpdir_path, "202206*"))
    assert june.columns == ["user_id", "keyword"] and june.count() == 4
    assert "extra" not in june._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_day_taken_from_last_date_segment(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "20991231", "logs")
    os.makedirs(base)
    with open(os.path.join(base, "20240107.json"), "w") as f:
        f.write('{"_source":{"Contract":"A","Mac":"m","AppName":"VOD","TotalDuration":7}}\n')
    got = files.content_range_scan(spark, base, dt.date(2024, 1, 7), dt.date(2024, 1, 7)).collect()
    assert [r.Process_Date for r in got] == [dt.date(2024, 1, 7)]
    sinks.write_content_log(TD.content_log(spark, SF, dt.date(2024, 1, 2), dt.date(2024, 1, 2)), base,
                            layout="partitioned")
    got = files.content_range_scan(spark, base, dt.date(2024, 1, 2), dt.date(2024, 1, 2), layout="partitioned")
    assert {r.Process_Date for r in got.collect()} == {dt.date(2024, 1, 2)}


def test_files_per_partition_bound(spark, tmpdir_path):
    flat = TD.content_log(spark, SF).repartition(12)
    sinks.write_content_log(flat, tmpdir_path, layout="partitioned", files_per_day=2)
    for d in os.listdir(tmpdir_path):
        if d.startswith("day="):
            parts = [f for f in os.listdir(os.path.join(tmpdir_path, d)) if f.startswith("part-")]
            assert 1 <= len(parts) <= 2
    back = files.content_range_scan(spark, tmpdir_path, dt.date(2024, 1, 1), dt.date(2024, 1, 31), layout="partitioned")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, flat.collect()))
