import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from viewlens import cli
from viewlens import schemas as S
from viewlens.operators.marts import ResultTableError, require_rows
from viewlens.plans.content import BrokenLines, content_table, publish_profile
from viewlens.plans.rfm import rfm_table, rfm_table_audited
from viewlens.sources import files, publish, sinks

DERBY = "org.apache.derby.jdbc.EmbeddedDriver"
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def ids(df):
    return sorted(r.id for r in df.collect())


def failing(spark, at=7):
    return spark.range(20).repartition(4).withColumn("id", F.when(F.col("id") == at, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))


def test_a_failing_job_leaves_the_old_table(spark, tmpdir_path):
    out = f"{tmpdir_path}/t"
    publish.publish(spark.range(3), out)
    with pytest.raises(Exception, match="lost"):
        publish.publish(failing(spark), out)
    assert ids(spark.read.parquet(out)) == [0, 1, 2]
    with pytest.raises(ResultTableError):
        publish.publish(spark.range(0), out, check=require_rows)
    assert ids(spark.read.parquet(out)) == [0, 1, 2]
    publish.publish(spark.read.parquet(out).filter("id > 0"), out)  # from the table that it replaces
    assert ids(spark.read.parquet(out)) == [1, 2]
    assert os.listdir(tmpdir_path) == ["t"]


def test_an_interrupted_swap_is_made_good(spark, tmpdir_path):
    out, old = f"{tmpdir_path}/t", f"{tmpdir_path}/_t.old"
    publish.publish(spark.range(2), out)
    os.rename(out, old)  # died after the first rename
    publish.recover(spark, out)
    assert ids(spark.read.parquet(out)) == [0, 1] and not os.path.exists(old)
    spark.range(9).write.parquet(old)  # died before the old one was deleted
    publish.publish(spark.range(1), out)
    assert ids(spark.read.parquet(out)) == [0] and os.listdir(tmpdir_path) == ["t"]


def test_csv_and_partitions(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, p string")
    publish.publish(df, f"{tmpdir_path}/c", "csv", require_rows, {"header": "true"})
    assert ids(spark.read.option("header", True).csv(f"{tmpdir_path}/c")) == ["1", "2"]
    publish.publish(df, f"{tmpdir_path}/p", partition_by=("p",))
    assert sorted(f for f in os.listdir(f"{tmpdir_path}/p") if f.startswith("p=")) == ["p=a", "p=b"]


def test_an_appending_run_adds_its_rows_once(spark, tmpdir_path):
    for run, n in (("a", 2), ("b", 3), ("b", 3), ("a", 2)):
        publish.append_once(spark.range(n), tmpdir_path, run)
    assert ids(publish.read_runs(spark, tmpdir_path)) == [0, 0, 1, 1, 2]
    for bad in ("x/y", "", "a b"):
        with pytest.raises(ValueError, match="run id"):
            publish.append_once(spark.range(1), tmpdir_path, bad)
    with pytest.raises(ValueError, match="run_id"):
        publish.append_once(spark.range(1).withColumn("run_id", F.lit(1)), tmpdir_path, "c")


def test_jdbc_runs(spark):
    url = "jdbc:derby:memory:viewlens_publish;create=true"

    def table():
        return sorted(tuple(r) for r in sinks.read_jdbc(spark, url, "PUBLISHED", driver=DERBY).collect())

    def load(rows, **options):
        return publish.publish_jdbc(spark.createDataFrame(rows, "Contract string, n int"), url, "PUBLISHED", driver=DERBY, **options)

    assert load([("A", 1)], run_id="one") and load([("B", 2)], run_id="two")
    assert not load([("B", 2)], run_id="two")  # repeated
    assert table() == [("A", 1), ("B", 2)]
    bad = failing(spark).select(F.col("id").cast("string").alias("Contract"), F.lit(1).alias("n"))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="lost"):
            publish.publish_jdbc(bad, url, "PUBLISHED", mode, "three", driver=DERBY)
        assert table() == [("A", 1), ("B", 2)]
    assert load([("C", 3)], mode="overwrite", run_id="three") and table() == [("C", 3)]
    names = [r[0] for r in sinks.read_jdbc(spark, url, "SYS.SYSTABLES", driver=DERBY).filter("TABLETYPE = 'T'").select("TABLENAME").collect()]
    assert sorted(names) == ["PUBLISHED", "VIEWLENS_RUNS"]  # no table left beside


GOOD = '{"_source": {"Contract": "%s", "Mac": "%s", "AppName": "VOD", "TotalDuration": 5}}'
BROKEN = ['{"_source": {"Contract": "A", "Mac', "not json at all", '{"_source": {"Contract": "A", "TotalDuration": "five"}}', '{"other": 1}', "[1, 2]"]


def day_log(folder, broken):
    os.makedirs(folder, exist_ok=True)
    for day in DAYS:
        with open(f"{folder}/{day:%Y%m%d}.json", "w") as f:
            f.write("\n".join([*(GOOD % (c, c + "1") for c in "AABC"), "", "  ", *(broken if day == DAYS[0] else [])]) + "\n")
    return folder


def test_broken_lines_are_kept_apart(spark, tmpdir_path):
    src, out, aside = day_log(f"{tmpdir_path}/src", BROKEN), f"{tmpdir_path}/out", f"{tmpdir_path}/aside"
    found = publish_profile(spark, src, DAYS, out, aside, max_share=0.5)
    assert found == {"lines": 13, "broken": 5}
    clean = day_log(f"{tmpdir_path}/clean", [])
    want = content_table(files.content_days(spark, clean, DAYS))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, want.collect()))
    bad = spark.read.parquet(aside).collect()
    assert sorted(r.line for r in bad) == sorted(BROKEN)
    assert {r.Process_Date for r in bad} == {DAYS[0]} and all(r.file.endswith("/20240101.json") for r in bad)
    assert {r.line: r.reason for r in bad}['{"other": 1}'] == "no _source"
    assert publish_profile(spark, clean, DAYS, out, aside) == {"lines": None, "broken": 0}
    assert spark.read.parquet(aside).count() == 0  # the last run had none


def test_too_many_broken_lines_keep_the_old_profile(spark, tmpdir_path):
    out, aside = f"{tmpdir_path}/out", f"{tmpdir_path}/aside"
    publish_profile(spark, day_log(f"{tmpdir_path}/clean", []), DAYS, out, aside)
    before = sorted(map(tuple, spark.read.parquet(out).collect()))
    src = day_log(f"{tmpdir_path}/src", BROKEN)
    with pytest.raises(BrokenLines, match="5 of 13"):
        publish_profile(spark, src, DAYS, out, aside, max_share=0.1)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == before
    assert spark.read.parquet(aside).count() == 5
    cli.main(["content", "--source", src, "--start", "20240101", "--end", "20240102", "--out", out, "--quarantine", aside, "--max-broken-share", "0.9"])
    assert spark.read.parquet(out).count() == len(before)


def test_audit_of_the_run(spark):
    d = dt.date(2024, 1, 1)
    data = [("1", 1, d, Decimal("0")), ("2", 1, d, Decimal("7")), ("3", 1, d, None), ("4", 0, d, Decimal("5")), ("5", None, d, Decimal("5")),
            ("6", 2, d, Decimal("5")), ("7", 3, d, Decimal("-5")), (None, 2, None, Decimal("1"))]
    tx = spark.createDataFrame(data, S.TRANSACTIONS)
    table, audit = rfm_table_audited(tx)
    assert audit == {"rows_before": 8, "rows_after": 3, "rows_removed": 5, "customers": 2}
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, rfm_table(tx).collect()))
    table, audit = rfm_table_audited(tx.limit(0))
    assert table.count() == 0 and set(audit.values()) == {0}


def test_cli_states(spark, tmpdir_path):
    src, state = day_log(f"{tmpdir_path}/src", []), f"{tmpdir_path}/state"
    cli.main(["devices", "--source", src, "--start", "20240101", "--end", "20240102", "--state", state, "--out", f"{tmpdir_path}/devices"])
    assert {r.Contract: r.Distinct_Devices for r in spark.read.parquet(f"{tmpdir_path}/devices").collect()} == {"A": 1, "B": 1, "C": 1}
    log = spark.createDataFrame([("20220601", "u", "a"), ("20220702", "u", "b")], "day string, user_id string, keyword string")
    sinks.write_parquet(log, f"{tmpdir_path}/log", partition_by=["day"])
    cli.main(["search-days", "--source", f"{tmpdir_path}/log", "--checkpoint", f"{tmpdir_path}/ckpt", "--state", f"{tmpdir_path}/counts",
              "--first", "20220601", "20220630", "--second", "20220701", "20220731", "--out", f"{tmpdir_path}/top"])
    assert sorted((r.period, r.keyword) for r in spark.read.parquet(f"{tmpdir_path}/top").collect()) == [(1, "a"), (2, "b")]
    for _ in range(2):
        cli.main(["devices", "--state", state, "--out", f"{tmpdir_path}/runs", "--mode", "append", "--run-id", "r1"])
    assert publish.read_runs(spark, f"{tmpdir_path}/runs").count() == 3
