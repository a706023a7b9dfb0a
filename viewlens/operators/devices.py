"""Mergeable distinct devices: a bitmap per contract and day.

A device gets a number within its contract, once and for all, in a dictionary that only grows. A day's devices of a contract
are then bits, and the devices of any set of days are the bits of the days OR-ed: exact, and without the log. A contract's
numbers are dense, so a bitmap is a few bytes; a contract with many devices has a row per 32,768 of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["Contract", "Mac"]
#: A contract's new devices are numbered in so many parts, so no task holds all devices of a large contract.
SALTS = 64


def new_devices(views: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(Contract, Mac, Device) of the devices that ``known`` lacks, numbered 1, 2 ... within the contract, after the known ones."""
    pairs = views.filter(F.col("Contract").isNotNull() & F.col("Mac").isNotNull()).select(*KEYS).distinct()
    if known is not None:
        pairs = pairs.join(known.select(*KEYS), KEYS, "left_anti")
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("Mac"), F.lit(SALTS)))
    before = Window.partitionBy("Contract").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = pairs.groupBy("Contract", "salt").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("Contract", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    if known is not None:
        last = known.groupBy("Contract").agg(F.max("Device").alias("last"))
        starts = starts.join(last, "Contract", "left").select("Contract", "salt", (F.col("start") + F.coalesce("last", F.lit(0))).alias("start"))
    place = F.row_number().over(Window.partitionBy("Contract", "salt").orderBy("Mac"))
    return pairs.withColumn("place", place).join(starts, ["Contract", "salt"]).select(*KEYS, (F.col("start") + F.col("place")).cast("long").alias("Device"))


def day_bitmaps(views: DataFrame, devices: DataFrame) -> DataFrame:
    """(Contract, Process_Date, bucket, devices): the day's devices as bits; a day without any known device has one empty bitmap."""
    seen = views.select("Contract", "Process_Date", "Mac").distinct()
    bits = seen.join(devices, KEYS, "left").select(
        "Contract", "Process_Date", F.coalesce(F.bitmap_bucket_number("Device"), F.lit(1)).cast("long").alias("bucket"),
        F.bitmap_bit_position("Device").alias("bit"))
    keys = ["Contract", "Process_Date", "bucket"]
    # bits, not bitmaps, are shuffled: they meet in one task before a bitmap is made
    made = bits.repartition(*keys).groupBy(*keys).agg(F.bitmap_construct_agg("bit").alias("devices"), F.max("bit").alias("most"))
    return made.select(*keys, F.expr("substring(devices, 1, CAST(coalesce(most, 0) div 8 + 1 AS INT))").alias("devices"))


def devices_of_days(bitmaps: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """(Contract, Distinct_Devices) over the days from ``start`` to ``end`` (both included; None: no bound)."""
    if start is not None:
        bitmaps = bitmaps.filter(F.col("Process_Date") >= F.lit(start))
    if end is not None:
        bitmaps = bitmaps.filter(F.col("Process_Date") <= F.lit(end))
    both = bitmaps.select("Contract", "bucket", "devices").repartition("Contract", "bucket")
    both = both.groupBy("Contract", "bucket").agg(F.bitmap_or_agg("devices").alias("devices"))
    return both.groupBy("Contract").agg(F.sum(F.bitmap_count("devices")).cast("long").alias("Distinct_Devices"))
