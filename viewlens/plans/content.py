"""Viewing log -> customer_content_stats."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.operators import content as C
from viewlens.sources import files
from viewlens.sources.publish import exists, publish


def content_daily(flat: DataFrame) -> DataFrame:
    """Daily profile with its MostWatch / Taste labels."""
    return C.with_labels(C.daily_profile(C.valid_views(flat)))


def content_table(flat: DataFrame, labels: str = "first_day",
                  threshold: int = S.ACTIVE_DAYS_THRESHOLD) -> DataFrame:
    """Contract, Total_Devices, five Total_* durations, MostWatch, Taste, Active."""
    return C.period_profile(content_daily(flat), labels, threshold)


class BrokenLines(ValueError):
    """More lines are broken than the caller accepts."""


def publish_profile(spark: SparkSession, source: str, days: Iterable[dt.date], out: str, quarantine: str, max_share: float = 0.01,
                    layout: str = "daily_files", labels: str = "first_day", threshold: int = S.ACTIVE_DAYS_THRESHOLD, fmt: str = "parquet",
                    options: dict | None = None) -> dict:
    """Profile of the given days' good lines to ``out``, their broken lines to ``quarantine`` (Parquet); the numbers of both.

    The profile's job also watches for broken lines. Without any, the log is read once. With some, a second job, of one stage, writes
    them and counts all lines; if their share exceeds ``max_share`` the run raises, the old profile stays, and the quarantine shows why.
    """
    lines = files.checked_content_days(spark, source, days, layout)
    bad = F.count_if(F.col("_reason").isNotNull()).alias("broken")
    watch, count = Observation("profile"), Observation("quarantine")
    table = content_table(files.good_lines(lines.observe(watch, bad)), labels, threshold)
    found = {"lines": None, "broken": 0}

    def check(_: DataFrame) -> None:
        if watch.get["broken"]:
            publish(files.broken_lines(lines.observe(count, F.count(F.lit(1)).alias("lines"), bad)), quarantine)
            found.update(count.get)
            if found["broken"] > max_share * found["lines"]:
                raise BrokenLines(f"{found['broken']} of {found['lines']} lines are broken, more than a share of {max_share}; see {quarantine}")
        elif exists(spark, quarantine):  # what an earlier run left there
            publish(files.broken_lines(lines).limit(0), quarantine)

    publish(table, out, fmt, check, options)
    return found
