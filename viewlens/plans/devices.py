"""The stored state of distinct devices: a dictionary that grows and a table of bitmaps by day.

``<base>/devices`` has a row per (contract, device), ``<base>/days`` the bitmaps, partitioned by day. Feeding a day again
replaces its bitmaps; its devices are in the dictionary already. A run that fails between the two leaves devices without
bits, which the next run finds numbered. One writer at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlens.operators import devices as D
from viewlens.sources.publish import exists
from viewlens.sources.sinks import write_parquet

_DICTIONARY = "Contract string, Mac string, Device long"
_DAYS = "Contract string, bucket long, devices binary, Process_Date date"


def dictionary(spark: SparkSession, base: str) -> DataFrame | None:
    path = f"{base.rstrip('/')}/devices"
    return spark.read.schema(_DICTIONARY).parquet(path) if exists(spark, path) else None


def add_days(views: DataFrame, base: str, files_per_day: int | None = None) -> None:
    """Add the days of ``views`` (Contract, Mac, Process_Date, all views of each day that occurs) to the state."""
    spark, base = views.sparkSession, base.rstrip("/")
    D.new_devices(views, dictionary(spark, base)).write.mode("append").parquet(f"{base}/devices")
    write_parquet(D.day_bitmaps(views, dictionary(spark, base)), f"{base}/days", partition_by=["Process_Date"], files_per_partition=files_per_day)


def distinct_devices(spark: SparkSession, base: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """(Contract, Distinct_Devices) of the stored days from ``start`` to ``end``; only these days' folders are read."""
    return D.devices_of_days(spark.read.schema(_DAYS).parquet(f"{base.rstrip('/')}/days"), start, end)


def days(spark: SparkSession, base: str) -> DataFrame:
    """(Process_Date, contracts) of the stored days."""
    state = spark.read.schema(_DAYS).parquet(f"{base.rstrip('/')}/days")
    return state.groupBy("Process_Date").agg(F.count_distinct("Contract").alias("contracts"))
