"""Transactions -> customer_rfm_stats."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.operators import rfm as R
from viewlens.session import stored


def customer_totals(tx: DataFrame) -> DataFrame:
    """Cleaned per-customer totals, stored once as columns: every score pass reads only the columns it needs."""
    return stored(R.customer_totals(R.clean(tx)), "customer-totals")


def rfm_base(tx: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Cleaned transactions -> per-customer base (no scores)."""
    return (R.with_aov(R.with_recency(customer_totals(tx), as_of))
            .select("CustomerID", "Recency", "Frequency", "Monetary", "AOV"))


def rfm_scores(tx: DataFrame, as_of: dt.date | None = None, n: int = S.RFM_TILES) -> DataFrame:
    """Base columns plus R/F/M scores and the RFM code, for any number of tiles.

    The job that stores the totals also observes their ranges, so scoring starts without a pass over them."""
    totals, seen = R.customer_totals(R.clean(tx)), Observation("customer totals")
    totals = stored(totals.observe(seen, *R.totals_ranges(totals)), "customer-totals")
    return R.scores_from_totals(totals, as_of, n, seen.get)


def rfm_table_audited(tx: DataFrame, as_of: dt.date | None = None) -> tuple[DataFrame, dict]:
    """The result table and the cleaning audit (rows_before, rows_after, rows_removed, customers), from one scan of ``tx``.

    Counts travel with the customers' totals and are observed where these are written, in the job's last stage, whose tasks count
    once even if executors are lost."""
    counted, seen = Observation("cleaning audit"), Observation("customer totals")
    kept = F.col("kept") > 0
    totals = R.audited_totals(tx).observe(counted, F.sum("rows").alias("rows_before"), F.sum("kept").alias("rows_after"),
                                          F.count_if(kept).alias("customers"))
    totals = totals.filter(kept).drop("rows", "kept")
    totals = stored(totals.observe(seen, *R.totals_ranges(totals)), "customer-totals")
    audit = {k: v or 0 for k, v in counted.get.items()}
    audit = {"rows_before": audit["rows_before"], "rows_after": audit["rows_after"],
             "rows_removed": audit["rows_before"] - audit["rows_after"], "customers": audit["customers"]}
    return R.output(R.segments(R.scores_from_totals(totals, as_of, known=seen.get))), audit


def rfm_scored(tx: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Scores with FM score and segment (five tiles)."""
    return R.segments(rfm_scores(tx, as_of))


def rfm_table(tx: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """CustomerID, Recency, Frequency, Monetary, AOV, RFM_Score, Segment."""
    return R.output(rfm_scored(tx, as_of))
