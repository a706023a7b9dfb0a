"""Viewing log -> daily and period profiles per contract.

The reference builds each day with two aggregates, an un-pinned pivot and
a join, then unions the days; here the daily profile is one aggregate over
all days (the join had identical keys on both sides), the pivot is pinned
to the five categories as conditional sums, and the period profile is one
more aggregate that also yields the activity label and the first-day labels.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.functions import labels as L

DAY_KEYS = ["Contract", "Process_Date"]


def flatten(raw: DataFrame) -> DataFrame:
    """``_source.*`` plus any outer columns other than ``_source``."""
    outer = [c for c in raw.columns if c != "_source"]
    return raw.select("_source.*", *outer)


def categorize(flat: DataFrame, categories: Mapping[str, Sequence[str]] = S.APP_CATEGORIES) -> DataFrame:
    """Add ``Type``; rows whose app code is unmapped (or NULL) are dropped."""
    return (flat.withColumn("Type", L.category_of_app(F.col("AppName"), categories))
            .filter(F.col("Type").isNotNull()))


def drop_placeholder(df: DataFrame, placeholder: str = S.PLACEHOLDER_CONTRACT) -> DataFrame:
    """Drop the placeholder contract; NULL contracts drop as well."""
    return df.filter(F.col("Contract") != placeholder)


def valid_views(flat: DataFrame) -> DataFrame:
    return drop_placeholder(categorize(flat))


def _duration_sums(categories: Sequence[str] = S.TASTE_ORDER):
    return [F.coalesce(F.sum(F.when(F.col("Type") == c, F.col("TotalDuration"))), F.lit(0)).cast("long")
            .alias(S.CATEGORY_COLUMNS[c]) for c in categories]


def daily_devices(valid: DataFrame) -> DataFrame:
    return valid.groupBy(*DAY_KEYS).agg(F.count_distinct("Mac").alias("Total_Devices"))


def daily_durations(valid: DataFrame) -> DataFrame:
    return valid.groupBy(*DAY_KEYS, "Type").agg(F.sum("TotalDuration").alias("Total_Duration"))


def daily_pivot(valid: DataFrame) -> DataFrame:
    """Category durations as five columns; a category absent on a day is 0."""
    return valid.groupBy(*DAY_KEYS).agg(*_duration_sums())


def daily_profile(valid: DataFrame) -> DataFrame:
    """Devices and the five durations per (contract, day) in one aggregate."""
    return valid.groupBy(*DAY_KEYS).agg(F.count_distinct("Mac").alias("Total_Devices"), *_duration_sums())


def _durations_by_label(prefix: str = "") -> dict[str, F.Column]:
    return {c: F.col(prefix + S.CATEGORY_COLUMNS[c]) for c in S.TASTE_ORDER}


def with_labels(df: DataFrame) -> DataFrame:
    """MostWatch and Taste from the five duration columns of each row."""
    d = _durations_by_label()
    return df.withColumn("MostWatch", L.most_watch(d)).withColumn("Taste", L.taste(d))


def activity(daily: DataFrame, threshold: int = S.ACTIVE_DAYS_THRESHOLD) -> DataFrame:
    """Active days per contract and the High/Low label."""
    return (daily.groupBy("Contract").agg(F.count_distinct("Process_Date").alias("Active_Days"))
            .withColumn("Active", L.activity(F.col("Active_Days"), threshold)))


def period_profile(daily_labeled: DataFrame, labels: str = "first_day",
                   threshold: int = S.ACTIVE_DAYS_THRESHOLD) -> DataFrame:
    """One row per contract.

    Total_Devices sums the daily distinct counts (as the reference does).
    ``labels="first_day"``: MostWatch/Taste of the contract's first active
    day; ``labels="period"``: recomputed on the period totals. The daily
    table has one row per (contract, day), so active days = row count.
    """
    dur = S.duration_columns()
    aggs = [F.sum("Total_Devices").cast("long").alias("Total_Devices")]
    aggs += [F.sum(c).cast("long").alias(c) for c in dur]
    aggs += [F.count(F.lit(1)).alias("_days")]
    if labels == "first_day":
        # Labels travel as small integers (category index, taste bit mask)
        # so the aggregate keeps fixed-width buffers and stays a hash
        # aggregate; they are decoded after the shuffle.
        aggs += [F.min_by(_most_watch_code(), "Process_Date").alias("_mw"),
                 F.min_by(_taste_mask(), "Process_Date").alias("_taste")]
    elif labels != "period":
        raise ValueError("labels must be 'first_day' or 'period'")
    out = daily_labeled.groupBy("Contract").agg(*aggs)
    if labels == "period":
        out = with_labels(out)
    else:
        out = out.withColumn("MostWatch", _most_watch_label(F.col("_mw"))).withColumn("Taste", _taste_label(F.col("_taste")))
    out = out.withColumn("Active", L.activity(F.col("_days"), threshold))
    return out.select(*S.CONTENT_PROFILE_COLUMNS)


def _most_watch_code() -> F.Column:
    """Index of MostWatch in the priority list (1-based)."""
    return F.array_position(F.array(*[F.lit(c) for c in S.MOST_WATCH_PRIORITY]), F.col("MostWatch")).cast("int")


def _most_watch_label(code: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(c) for c in S.MOST_WATCH_PRIORITY]), code)


def _taste_mask() -> F.Column:
    """Bit i set when the i-th Taste category has a positive duration."""
    bits = [F.when(F.col(S.CATEGORY_COLUMNS[c]) > 0, F.lit(1 << i)).otherwise(F.lit(0))
            for i, c in enumerate(S.TASTE_ORDER)]
    return sum(bits[1:], bits[0])


def _taste_label(mask: F.Column) -> F.Column:
    return F.concat_ws("-", *[F.when((mask.bitwiseAND(F.lit(1 << i))) != 0, F.lit(c))
                              for i, c in enumerate(S.TASTE_ORDER)])


def distinct_devices(valid: DataFrame) -> DataFrame:
    """Distinct devices per contract over the whole period."""
    return valid.groupBy("Contract").agg(F.count_distinct("Mac").alias("Distinct_Devices"))
