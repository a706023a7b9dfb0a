"""Incremental daily content profiles with Structured Streaming.

Viewing logs arrive as day files. A file-source stream picks up new files;
each micro-batch finds the days it touched (a handful of values), rebuilds
those days' profiles from all of their files, and overwrites just those
day partitions of the sink (dynamic partition overwrite). A day that
arrives in several files is therefore always complete, and a replayed
micro-batch after a failure rewrites the same partitions with the same
rows -- the sink is exactly-once in effect. Daily device counts cannot be
merged; the bitmaps of ``plans.devices``, which the stream can keep beside,
can.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewlens import schemas as S
from viewlens.operators import content as C
from viewlens.plans import devices as device_state
from viewlens.plans.content import content_daily
from viewlens.sources import files
from viewlens.sources.sinks import cluster_for_write


def _with_day(raw: DataFrame) -> DataFrame:
    return C.flatten(files.with_path_day(raw, "Process_Date"))


def _touched_days(batch: DataFrame) -> list[dt.date]:
    # One row per day present in the micro-batch: a bounded summary.
    return sorted(r.Process_Date for r in batch.select("Process_Date").distinct().collect()
                  if r.Process_Date is not None)


def start_daily_profiles(spark: SparkSession, source: str, sink: str, checkpoint_location: str,
                         layout: str = "daily_files", available_now: bool = True,
                         max_files_per_trigger: int | None = None,
                         files_per_day: int | None = None, devices: str | None = None) -> StreamingQuery:
    """Start the stream ``source`` day files -> ``sink`` Parquet partitioned by day.

    ``devices``: a folder in which the distinct devices of the touched days are kept as well (``plans.devices``).
    """
    pattern = f"{source.rstrip('/')}/*.json" if layout == "daily_files" else f"{source.rstrip('/')}/day=*"
    reader = spark.readStream.schema(S.CONTENT_LOG_JSON)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = _with_day(reader.json(pattern))

    def upsert_days(batch: DataFrame, epoch_id: int) -> None:
        days = _touched_days(batch)
        if not days:
            return
        full = files.content_days(batch.sparkSession, source, days, layout)
        daily = content_daily(full).withColumn("day", F.date_format("Process_Date", "yyyy-MM-dd"))
        if devices is not None:
            device_state.add_days(C.valid_views(full), devices, files_per_day)
        daily = cluster_for_write(daily, ["day"], files_per_day)
        (daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day").parquet(sink))

    writer = stream.writeStream.foreachBatch(upsert_days).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_daily_profiles(spark: SparkSession, sink: str) -> DataFrame:
    """The sink as a daily profile table (partition column dropped)."""
    return spark.read.parquet(sink).drop("day")


def profile_from_daily(spark: SparkSession, sink: str, start: dt.date | None = None,
                       end: dt.date | None = None, labels: str = "first_day") -> DataFrame:
    """customer_content_stats over a day range of the streamed daily table."""
    daily = read_daily_profiles(spark, sink)
    if start is not None:
        daily = daily.filter(F.col("Process_Date") >= F.lit(start))
    if end is not None:
        daily = daily.filter(F.col("Process_Date") <= F.lit(end))
    return C.period_profile(daily, labels)
