"""Search log -> top keyword per user and period -> change of genre.

All operators work on a *tagged* log ``(period, user_id, keyword)`` so the
two months are processed in one scan and one aggregation; ``period`` is an
integer (1 = first month, 2 = second) and the output labels come from
``labels``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.functions import labels as L
from viewlens.operators.joins import salted_join

USER = "user_id"


def tag(df: DataFrame, period: int) -> DataFrame:
    return df.withColumn("period", F.lit(period))


def counts(log: DataFrame) -> DataFrame:
    """Searches per (period, user, keyword); NULL keywords are not counted.

    Filtering NULL before the aggregate is equivalent to the reference's
    filter after the top-1 (a NULL group counts 0 and ranks last) and lets
    the filter reach the scan.
    """
    return (log.filter(F.col("keyword").isNotNull())
            .groupBy("period", USER, "keyword").agg(F.count("keyword").alias("search_count")))


def day_counts(log: DataFrame) -> DataFrame:
    """Searches per (day, user, keyword): what a day adds to the counts of any period that holds it."""
    return (log.filter(F.col("day").isNotNull() & F.col("keyword").isNotNull())
            .groupBy("day", USER, "keyword").agg(F.count("keyword").alias("search_count")))


def counts_of_days(by_day: DataFrame, periods: Mapping[int, tuple[dt.date, dt.date]]) -> DataFrame:
    """Searches per (period, user, keyword) from day counts; ``periods``: first and last day of each, which may not overlap."""
    period = None
    for p, (first, last) in periods.items():
        here = F.col("day").between(F.lit(first), F.lit(last))
        period = F.when(here, p) if period is None else period.when(here, p)
    spans = sorted(periods.values())
    if any(a[1] >= b[0] for a, b in zip(spans, spans[1:], strict=False)):
        raise ValueError(f"periods overlap: {spans}")
    inside = F.lit(False)
    for first, last in spans:
        inside = inside | F.col("day").between(F.lit(first), F.lit(last))
    return (by_day.filter(inside).withColumn("period", period)
            .groupBy("period", USER, "keyword").agg(F.sum("search_count").alias("search_count")))


def top_keyword(log: DataFrame) -> DataFrame:
    """Most searched keyword per (period, user); ties -> keyword ascending."""
    return top_of_counts(counts(log))


def top_of_counts(counted: DataFrame) -> DataFrame:
    """The keyword of the largest count per (period, user); ties -> keyword ascending.

    ``row_number() == 1`` directly over the window lets Spark insert a
    partial WindowGroupLimit before the shuffle: each task forwards at most
    one row per user, so a user with a huge number of distinct keywords
    does not become one hot partition.
    """
    w = Window.partitionBy("period", USER).orderBy(F.col("search_count").desc(), F.col("keyword").asc())
    return (counted.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def distinct_keywords(log: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct non-NULL keywords over all periods (one row)."""
    f = F.approx_count_distinct if approx else F.count_distinct
    return log.agg(f("keyword").alias("distinct_keywords"))


def keyword_popularity(top: DataFrame, k: int = 20) -> DataFrame:
    """Per period, the k keywords that are the top keyword of most users."""
    per = top.groupBy("period", "keyword").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("period").orderBy(F.col("count").desc(), F.col("keyword").asc())
    return per.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def mapped(top: DataFrame, mapping: DataFrame) -> DataFrame:
    """Keep (period, user) rows whose keyword is labelled for that period.

    A left-semi join: the mapping may repeat a keyword (it is built from
    per-user rows), and a semi join cannot fan out.
    """
    keys = mapping.select("period", "keyword")
    return top.join(keys, ["period", "keyword"], "left_semi")


def genre_dimension(mapping: DataFrame) -> DataFrame:
    """keyword -> Genre; a keyword labelled differently in two periods keeps
    the earliest period's label (then the smallest label), deterministically.
    Also lists the periods in which the keyword is labelled (at most one
    entry per period)."""
    return (mapping.filter(F.col("keyword").isNotNull())
            .groupBy("keyword")
            .agg(F.min(F.struct("period", "Genre")).getField("Genre").alias("Genre"),
                 F.array_sort(F.collect_set("period")).alias("periods")))


def period_pivot(mapped_top: DataFrame, periods: Sequence[int] = (1, 2),
                 labels: Sequence[str] = S.PERIOD_LABELS) -> DataFrame:
    """One row per user with the top keyword of every period; users missing
    a period are dropped."""
    aggs = [F.max(F.when(F.col("period") == p, F.col("keyword"))).alias(f"Most_Searched_{lab}")
            for p, lab in zip(periods, labels)]
    out = mapped_top.groupBy(USER).agg(*aggs)
    for lab in labels:
        out = out.filter(F.col(f"Most_Searched_{lab}").isNotNull())
    return out


def genre_enrich(pivot: DataFrame, dim: DataFrame, labels: Sequence[str] = S.PERIOD_LABELS) -> DataFrame:
    """Left-join the genre of each period's keyword."""
    out = pivot
    for lab in labels:
        d = dim.select(F.col("keyword").alias(f"_kw_{lab}"), F.col("Genre").alias(f"Genre_{lab}"))
        out = (out.join(d, out[f"Most_Searched_{lab}"] == d[f"_kw_{lab}"], "left").drop(f"_kw_{lab}"))
    cols = [USER] + [c for lab in labels for c in (f"Most_Searched_{lab}", f"Genre_{lab}")]
    return out.select(*cols)


def with_changing(enriched: DataFrame, labels: Sequence[str] = S.PERIOD_LABELS) -> DataFrame:
    a, b = labels[0], labels[-1]
    return enriched.withColumn("Changing", L.change_label(F.col(f"Genre_{a}"), F.col(f"Genre_{b}")))


def change_table(log: DataFrame, mapping: DataFrame, periods: Sequence[int] = (1, 2),
                 labels: Sequence[str] = S.PERIOD_LABELS, salt_buckets: int = 0) -> DataFrame:
    """Fused plan of the whole search pipeline.

    Top keyword per (period, user), then ONE join with the genre dimension
    (it carries each keyword's labelled periods, which replaces the
    per-period semi joins), then one aggregate per user that pivots the
    periods. Join strategy is the optimizer's: broadcast when the runtime
    size of the dimension is under the threshold, else a sort-merge join
    with AQE splitting a skewed (very popular) keyword's partition.
    ``salt_buckets > 1`` salts the join explicitly instead (see
    ``operators.joins.salted_join``), independent of AQE settings.
    """
    return change_of_top(top_keyword(log), genre_dimension(mapping), periods, labels, salt_buckets)


def change_of_top(top: DataFrame, dim: DataFrame, periods: Sequence[int] = (1, 2), labels: Sequence[str] = S.PERIOD_LABELS,
                  salt_buckets: int = 0) -> DataFrame:
    """``change_table`` from top keywords and the genre dimension."""
    joined = (salted_join(top, dim, ["keyword"], salt_buckets, salt_from=["period", USER])
              if salt_buckets > 1 else top.join(dim, "keyword"))
    hit = (joined.filter(F.array_contains(F.col("periods"), F.col("period")))
           .select("period", USER, "keyword", "Genre"))
    aggs = []
    for p, lab in zip(periods, labels):
        aggs += [F.max(F.when(F.col("period") == p, F.col("keyword"))).alias(f"Most_Searched_{lab}"),
                 F.max(F.when(F.col("period") == p, F.col("Genre"))).alias(f"Genre_{lab}")]
    out = hit.groupBy(USER).agg(*aggs)
    for lab in labels:
        out = out.filter(F.col(f"Most_Searched_{lab}").isNotNull())
    cols = [USER] + [c for lab in labels for c in (f"Most_Searched_{lab}", f"Genre_{lab}")]
    return with_changing(out.select(*cols), labels)


def normalize(df: DataFrame, names: Sequence[str] = S.SEARCH_CHANGE_COLUMNS) -> DataFrame:
    """Canonical column names (matched case-insensitively) and trimmed strings."""
    canon = {n.lower(): n for n in names}
    renamed = df.withColumnsRenamed({c: canon[c.lower()] for c in df.columns if c.lower() in canon})
    strings = [f.name for f in renamed.schema.fields if f.dataType.simpleString() == "string"]
    return renamed.withColumns({c: F.trim(F.col(c)) for c in strings})
