"""Daily profiles kept up to date by a ledger of the files read.

The ledger has a row per log file: path, size, time of change, day. A run lists the log, compares it with the ledger, and
rebuilds exactly the days of which a file is new, changed or gone; all other files stay unread. The profiles are written
first and the ledger last, so a run that fails in between is repeated by the next one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewlens.plans.content import content_daily
from viewlens.sources import files
from viewlens.sources.publish import exists, publish, remove
from viewlens.sources.sinks import write_parquet

_LEDGER = "path string, size long, modified timestamp, day date"


def listing(spark: SparkSession, source: str, layout: str = "daily_files") -> DataFrame:
    """(path, size, modified, day) of the log's files; their contents stay unread."""
    paths = files.day_paths(spark, source, files.present_days(spark, source, layout), layout)
    if not paths:
        return spark.createDataFrame([], _LEDGER)
    found = files.with_path_day(spark.read.format("binaryFile").load(paths), "day")
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "day")


def changed_days(now: DataFrame, before: DataFrame) -> DataFrame:
    """(day, present): days of which a file is new, changed or gone, and whether the log still has files of the day."""
    old = before.select(F.col("path").alias("old_path"), F.col("size").alias("old_size"), F.col("modified").alias("old_modified"), F.col("day").alias("old_day"))
    both = now.join(old, F.col("path") == F.col("old_path"), "full_outer")
    same = F.col("size").eqNullSafe(F.col("old_size")) & F.col("modified").eqNullSafe(F.col("old_modified"))
    days = both.groupBy(F.coalesce("day", "old_day").alias("day")).agg(
        F.bool_or(~same).alias("changed"), F.bool_or(F.col("path").isNotNull()).alias("present"))
    return days.filter("changed AND day IS NOT NULL").select("day", "present")


def refresh_daily(spark: SparkSession, source: str, sink: str, ledger: str, layout: str = "daily_files",
                  files_per_day: int | None = None) -> list[dt.date]:
    """Bring the daily profiles in ``sink`` (as the stream writes them, by ``day``) up to date; the days that were rebuilt. One writer at a time."""
    now = listing(spark, source, layout)
    before = spark.read.schema(_LEDGER).parquet(ledger) if exists(spark, ledger) else spark.createDataFrame([], _LEDGER)
    changed = sorted(changed_days(now, before).collect())  # a row per changed day
    days, made = [r.day for r in changed if r.present], set()
    if days:
        daily = content_daily(files.content_days(spark, source, days, layout)).withColumn("day", F.date_format("Process_Date", "yyyy-MM-dd"))
        seen = Observation("refreshed days")
        write_parquet(daily.observe(seen, F.collect_set("day").alias("days")), sink, partition_by=["day"], files_per_partition=files_per_day)
        made = set(seen.get["days"] or [])
    for r in changed:  # nothing is left of these days
        if r.day.isoformat() not in made:
            remove(spark, f"{sink.rstrip('/')}/day={r.day.isoformat()}")
    if changed:
        publish(now, ledger)
    return [r.day for r in changed]
