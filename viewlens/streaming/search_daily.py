"""Search logs by day folder, streamed into the stored count state (``plans.search_state``).

A file stream picks up new files of ``<source>/day=<yyyyMMdd>/`` (Parquet). A micro-batch finds the days that it touched and
counts these again from all of their files, so a day that comes in several files, or late, is complete, and a replayed
micro-batch writes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from viewlens.plans import search_state
from viewlens.sources import files


def start_daily_counts(spark: SparkSession, source: str, state: str, checkpoint_location: str, available_now: bool = True,
                       max_files_per_trigger: int | None = None, files_per_day: int | None = None) -> StreamingQuery:
    """Start the stream ``source`` day folders -> ``state``."""
    source = source.rstrip("/")
    reader = spark.readStream.schema("user_id string, keyword string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = files.with_path_day(reader.parquet(f"{source}/day=*"), "day").select("day")

    def count_days(batch: DataFrame, epoch_id: int) -> None:
        touched = sorted(r.day for r in batch.distinct().collect() if r.day is not None)  # the days of a micro-batch: a few
        if touched:
            search_state.add_days(files.search_days(batch.sparkSession, source, touched), state, files_per_day)

    writer = stream.writeStream.foreachBatch(count_days).option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
