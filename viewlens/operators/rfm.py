"""Recency / frequency / monetary scoring of customers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.functions import labels as L
from viewlens.functions.exact import cents, ratio_half_up
from viewlens.operators.ntile import global_ntiles, ranges


def clean(tx: DataFrame) -> DataFrame:
    """Keep GMV > 0 and a real customer id (0 and NULL are dropped)."""
    return tx.filter((F.col("GMV") > 0) & (F.col("CustomerID") != 0))


def clean_audit(tx: DataFrame) -> DataFrame:
    """Rows before and after cleaning, and customers kept, in one pass."""
    ok = (F.col("GMV") > 0) & (F.col("CustomerID") != 0)
    return tx.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.coalesce(ok, F.lit(False))).alias("rows_after"),
        F.count_distinct(F.when(ok, F.col("CustomerID"))).alias("customers"),
    ).select("rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
             "customers")


def customer_totals(tx: DataFrame) -> DataFrame:
    """Per customer: last purchase date, frequency, exact monetary total.

    One hash aggregate with map-side partial combine: a customer holding a
    large share of transactions is pre-aggregated in every input task.
    """
    return tx.groupBy("CustomerID").agg(
        F.max("Purchase_Date").alias("Last_Purchase"),
        F.count("Transaction_ID").alias("Frequency"),
        F.sum("GMV").alias("Monetary"),
    )


def audited_totals(tx: DataFrame) -> DataFrame:
    """``customer_totals`` of all transactions' valid ones, with the customer's transactions before (``rows``) and after cleaning (``kept``).

    A customer without valid transactions, and the rows without a customer, are groups with ``kept`` 0."""
    ok = F.coalesce((F.col("GMV") > 0) & (F.col("CustomerID") != 0), F.lit(False))
    return tx.groupBy("CustomerID").agg(
        F.max(F.when(ok, F.col("Purchase_Date"))).alias("Last_Purchase"),
        F.count(F.when(ok, F.col("Transaction_ID"))).alias("Frequency"),
        F.sum(F.when(ok, F.col("GMV"))).alias("Monetary"),
        F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("kept"),
    )


def with_recency(totals: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Recency = days from last purchase to the reference date.

    The reference date defaults to the latest purchase overall plus one day,
    computed from the (much smaller) per-customer table -- the max of the
    per-customer maxima -- as a scalar subquery, evaluated once.
    """
    ref = F.lit(as_of) if as_of is not None else totals.agg(F.date_add(F.max("Last_Purchase"), 1)).scalar()
    return totals.withColumn("Recency", F.date_diff(ref, F.col("Last_Purchase")))


def with_aov(df: DataFrame) -> DataFrame:
    """AOV = Monetary / Frequency rounded half up to whole units (exact)."""
    return df.withColumn("AOV", ratio_half_up(cents(F.col("Monetary")), F.col("Frequency") * F.lit(100), 0))


def base(tx_clean: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """CustomerID, Recency, Frequency, Monetary (decimal), AOV."""
    totals = customer_totals(tx_clean)
    return with_aov(with_recency(totals, as_of)).select("CustomerID", "Recency", "Frequency", "Monetary", "AOV")


def score_orders() -> dict[str, Column]:
    """What each tile orders by. Recency ascending is Last_Purchase descending (NULLs first), so it needs no reference date."""
    return {"_r_tile": -F.unix_date("Last_Purchase"), "F_Score": F.col("Frequency"), "M_Score": F.col("Monetary")}


def totals_ranges(totals: DataFrame) -> list[Column]:
    """Aggregates over the totals that scoring needs first; the job that stores them can observe these."""
    return [*ranges(totals, score_orders(), "CustomerID"), F.max("Last_Purchase").alias("last_purchase")]


def scores_from_totals(totals: DataFrame, as_of: dt.date | None = None, n: int = S.RFM_TILES, known: Mapping | None = None) -> DataFrame:
    """R = n+1 - ntile over Recency; F, M = ntile over Frequency, Monetary; with Recency, AOV and the RFM code.

    Ties are broken by CustomerID ascending. All three scores share the passes over ``totals``. ``known``: the values of
    ``totals_ranges``, if they are known already.
    """
    if as_of is None and known is not None and known["last_purchase"] is not None:
        as_of = known["last_purchase"] + dt.timedelta(days=1)
    df = with_aov(with_recency(global_ntiles(totals, score_orders(), n, "CustomerID", known), as_of))
    df = df.withColumn("R_Score", (F.lit(n + 1) - F.col("_r_tile")).cast("int")).drop("_r_tile")
    return df.withColumn("RFM_Score", L.rfm_code(F.col("R_Score"), F.col("F_Score"), F.col("M_Score")))


def segments(scored: DataFrame, n: int = S.RFM_TILES) -> DataFrame:
    """FM score and segment; the segment rules are defined on five tiles only."""
    if n != S.RFM_TILES:
        raise ValueError(f"segments are defined for {S.RFM_TILES} tiles, not {n}")
    fm = L.fm_score(F.col("F_Score"), F.col("M_Score"))
    return (scored.withColumn("FM_Score", fm)
            .withColumn("Segment", L.segment(F.col("R_Score"), F.col("FM_Score"))))


def output(seg: DataFrame) -> DataFrame:
    """Result table columns; money leaves as double (exact decimal inside)."""
    return seg.select("CustomerID", "Recency", "Frequency", F.col("Monetary").cast("double").alias("Monetary"),
                      "AOV", "RFM_Score", "Segment")


def segment_counts(result: DataFrame) -> DataFrame:
    """Customers per segment, most first (ties by name)."""
    return result.groupBy("Segment").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "Segment")
