"""The stored state of search counts, by day, user and keyword: a day is added or replaced, tops come from the sum.

The state is a Parquet table partitioned by day. Feeding a day again replaces its counts, so a replay changes nothing; the
counts of a period are the sums over its days, and the top keyword of a user comes from these, without the log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlens.operators import search as Q
from viewlens.sources.sinks import write_parquet

_STATE = "user_id string, keyword string, search_count long, day date"
#: Days of a period, first and last included.
Days = tuple[dt.date, dt.date]


def add_days(log: DataFrame, base: str, files_per_day: int | None = None) -> None:
    """Add the days of ``log`` (day, user_id, keyword, all searches of each day that occurs) to the state."""
    write_parquet(Q.day_counts(log), base, partition_by=["day"], files_per_partition=files_per_day)


def read(spark: SparkSession, base: str) -> DataFrame:
    """(day, user_id, keyword, search_count) of all stored days."""
    return spark.read.schema(_STATE).parquet(base)


def period_counts(spark: SparkSession, base: str, periods: Mapping[int, Days]) -> DataFrame:
    """(period, user_id, keyword, search_count) over the days of each period; other days' folders are not read."""
    return Q.counts_of_days(read(spark, base), periods)


def top_keyword(spark: SparkSession, base: str, periods: Mapping[int, Days]) -> DataFrame:
    """(period, user_id, keyword, search_count): each user's top keyword of each period."""
    return Q.top_of_counts(period_counts(spark, base, periods))
