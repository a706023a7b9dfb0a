"""Report marts over the three customer tables (the dashboard's numbers).

Every mart is a DataFrame -> DataFrame aggregate; results are small (a
row per segment / category / genre pair / top-k entry), inputs can be the
full customer tables. NULL keys are left out of counts, as in pandas'
``value_counts``. Means are exact sums divided by counts; marts the
dashboard rounds to one decimal use exact half-to-even rounding. Money
columns are doubles holding whole cents; they are summed as integer cents
so totals do not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.functions import labels as L
from viewlens.functions.exact import int_div_long, ratio, ratio_half_even

# ── shared helpers ─────────────────────────────────────────────────────────


def filter_in(df: DataFrame, **allowed: Sequence[str] | None) -> DataFrame:
    """Keep rows whose column values are in the allowed lists.

    None stands for the dashboard's default selection, all non-NULL values;
    NULL values never match, as with pandas ``isin``.
    """
    for col, values in allowed.items():
        df = df.filter(F.col(col).isNotNull() if values is None else F.col(col).isin(list(values)))
    return df


def _counts(df: DataFrame, col: str, count_name: str = "Count") -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_name))


def value_counts(df: DataFrame, col: str, count_name: str = "Count") -> DataFrame:
    """Rows per non-NULL value, most first, ties by value (a sort of the small count table)."""
    return _counts(df, col, count_name).orderBy(F.desc(count_name), col)


def top_k(df: DataFrame, col: str, k: int, count_name: str = "Count") -> DataFrame:
    """The k most frequent non-NULL values; ties by value ascending.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps k
    rows, so nothing large reaches the final step.
    """
    return value_counts(df, col, count_name).limit(k)


def with_share(counts: DataFrame, count_name: str = "Count", share_name: str = "Share") -> DataFrame:
    """Add count / total.

    Only for count tables with a handful of rows by construction (segments,
    activity labels, change statuses): the total is a window over the whole
    table, so the counts -- and the pipeline beneath them -- are computed
    once.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shares = counts.withColumn(share_name, ratio(F.col(count_name), F.sum(count_name).over(everything)))
    return shares.orderBy(F.desc(count_name), counts.columns[0])


def money_cents(c: str) -> Column:
    """A money double (whole cents) as an exact integer number of cents."""
    return F.round(F.col(c) * F.lit(100)).cast("long")


def mean(col: str, value: Column | None = None, unit: int = 1) -> Column:
    """Exact mean over the rows where ``col`` is not NULL; ``value``: its exact integer form, in 1/``unit``."""
    return ratio(F.sum(value if value is not None else F.col(col)), F.count(col) * F.lit(unit))


def mean1(col: str, value: Column | None = None, unit: int = 1) -> Column:
    """The same mean rounded half-even to one decimal."""
    return ratio_half_even(F.sum(value if value is not None else F.col(col)), F.count(col) * F.lit(unit), 1)


# ── RFM marts ──────────────────────────────────────────────────────────────


def rfm_filtered(rfm: DataFrame, segments: Sequence[str] | None = None) -> DataFrame:
    return filter_in(rfm, Segment=segments)


def rfm_kpis(rfm: DataFrame) -> DataFrame:
    return rfm.agg(
        F.count(F.lit(1)).alias("customers"),
        mean("Recency").alias("avg_recency"),
        mean("Frequency").alias("avg_frequency"),
        mean("Monetary", money_cents("Monetary"), 100).alias("avg_monetary"),
        mean("AOV", F.col("AOV").cast("long")).alias("avg_aov"),
    )


def rfm_segment_counts(rfm: DataFrame) -> DataFrame:
    return value_counts(rfm, "Segment")


def rfm_segment_revenue(rfm: DataFrame) -> DataFrame:
    return (rfm.filter(F.col("Segment").isNotNull()).groupBy("Segment")
            .agg((F.coalesce(F.sum(money_cents("Monetary")), F.lit(0)).cast("double") / F.lit(100.0)).alias("Revenue"))
            .orderBy(F.desc("Revenue"), "Segment"))


def rfm_segment_share(rfm: DataFrame) -> DataFrame:
    return with_share(_counts(rfm, "Segment"))


def top_rfm_scores(rfm: DataFrame, k: int = 20) -> DataFrame:
    return top_k(rfm, "RFM_Score", k)


def rfm_segment_stats(rfm: DataFrame) -> DataFrame:
    cents = money_cents("Monetary")
    return (rfm.filter(F.col("Segment").isNotNull()).groupBy("Segment").agg(
        F.count("CustomerID").alias("Customers"),
        mean1("Recency").alias("Avg_Recency"),
        mean1("Frequency").alias("Avg_Frequency"),
        mean1("Monetary", cents, 100).alias("Avg_Monetary"),
        mean1("AOV", F.col("AOV").cast("long")).alias("Avg_AOV"),
        ratio_half_even(F.coalesce(F.sum(cents), F.lit(0)), F.lit(100), 1).alias("Total_Revenue"),
    ).orderBy(F.desc("Customers"), "Segment"))


# ── Content marts ──────────────────────────────────────────────────────────

_LABEL_COLUMN = {c: S.CATEGORY_COLUMNS[c] for c in S.DASHBOARD_CATEGORY_ORDER}


def content_filtered(content: DataFrame, most_watch: Sequence[str] | None = None,
                     active: Sequence[str] | None = None) -> DataFrame:
    return filter_in(content, MostWatch=most_watch, Active=active)


def content_kpis(content: DataFrame) -> DataFrame:
    """Users, share of High (percent), mean devices, total duration; 0 when empty."""
    n = F.count(F.lit(1))
    total = sum((F.coalesce(F.sum(c), F.lit(0)) for c in _LABEL_COLUMN.values()), F.lit(0))
    return content.agg(
        n.alias("users"),
        F.coalesce(ratio(F.count_if(F.col("Active") == "High") * F.lit(100), n), F.lit(0.0)).alias("high_pct"),
        F.coalesce(mean("Total_Devices"), F.lit(0.0)).alias("avg_devices"),
        total.cast("long").alias("total_duration"),
    )


def _category_rows(wide: DataFrame, value_name: str) -> DataFrame:
    """One row per category from a one-row frame with a column per category."""
    pairs = [F.struct(F.lit(label).alias("Category"), F.col(col).alias(value_name))
             for label, col in _LABEL_COLUMN.items()]
    return wide.select(F.inline(F.array(*pairs)))


def content_durations(content: DataFrame) -> DataFrame:
    sums = content.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in _LABEL_COLUMN.values()])
    return _category_rows(sums, "Duration")


def content_avg_durations(content: DataFrame) -> DataFrame:
    means = content.agg(*[mean(c).alias(c) for c in _LABEL_COLUMN.values()])
    return _category_rows(means, "Avg_Duration")


def content_most_watch(content: DataFrame) -> DataFrame:
    return value_counts(content, "MostWatch")


def content_active(content: DataFrame) -> DataFrame:
    return with_share(_counts(content, "Active"))


def top_taste(content: DataFrame, k: int) -> DataFrame:
    return top_k(content, "Taste", k)


def most_watch_active(content: DataFrame) -> DataFrame:
    return (content.filter(F.col("MostWatch").isNotNull() & F.col("Active").isNotNull())
            .groupBy("MostWatch", "Active").agg(F.count(F.lit(1)).alias("Count")).orderBy("MostWatch", "Active"))


def most_watch_stats(content: DataFrame) -> DataFrame:
    means = [mean1(col).alias("Avg_" + col[len("Total_"):]) for col in _LABEL_COLUMN.values()]
    high = ratio_half_even(F.count_if(F.col("Active") == "High") * F.lit(100), F.count(F.lit(1)), 1)
    return (content.filter(F.col("MostWatch").isNotNull()).groupBy("MostWatch").agg(
        F.count("Contract").alias("Users"), mean1("Total_Devices").alias("Avg_Devices"), *means, high.alias("High_Pct"),
    ).orderBy(F.desc("Users"), "MostWatch"))


def device_histogram(content: DataFrame, bins: int = 40, clip_quantile: float = 0.95,
                     approx: bool = False) -> DataFrame:
    """Devices clipped at int(quantile), counted in ``bins`` equal-width bins.

    The quantile is exact with linear interpolation (as pandas), or
    ``percentile_approx`` when ``approx``. Bin edges span the clipped
    [min, max]; the maximum falls into the last bin. Device counts are
    integers, so int(quantile) >= min and the clipped range is [min, cap].
    Contracts are counted per device count first: the percentile (with
    frequencies) and the bins both come from that table of distinct device
    counts, so no task or buffer holds the contracts. Bin index arithmetic
    is integer, so membership is exact. Only non-empty bins are returned.
    """
    x = F.col("Total_Devices")
    counts = content.filter(x.isNotNull()).groupBy(x).agg(F.count(F.lit(1)).alias("_n"))
    return histogram_of_counts(counts, bins, clip_quantile, content if approx else None)


def histogram_of_counts(counts: DataFrame, bins: int = 40, clip_quantile: float = 0.95, approx_of: DataFrame | None = None) -> DataFrame:
    """``device_histogram`` from (Total_Devices, _n): contracts per device count."""
    x, w = F.col("Total_Devices"), F.col("_n")
    q = F.percentile(x, clip_quantile, w) if approx_of is None else F.percentile_approx(x, clip_quantile, 10_000)
    stats = (counts if approx_of is None else approx_of).agg(F.struct(F.min(x).alias("lo"), q.cast("long").alias("hi"))).scalar()
    clipped = (counts.select(x.alias("_x"), w, stats.alias("_s"))
               .select(F.least(F.col("_x"), F.col("_s.hi")).alias("x"), w,
                       F.col("_s.lo").alias("_lo"), F.col("_s.hi").alias("_hi")))
    span = F.col("_hi") - F.col("_lo")
    idx = F.when(span == 0, F.lit(0)).otherwise(
        F.least(int_div_long((F.col("x") - F.col("_lo")) * F.lit(bins), span), F.lit(bins - 1))).cast("int")
    counted = (clipped.withColumn("bin", idx)
               .groupBy("bin", "_lo", "_hi").agg(F.sum(w).alias("Count")))
    width = (F.col("_hi") - F.col("_lo")).cast("double") / F.lit(float(bins))
    return counted.select(
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + F.lit(1)) * width).alias("bin_end"),
        "Count",
    )


# ── Search marts ───────────────────────────────────────────────────────────


def search_filtered(search: DataFrame, genres_first: Sequence[str] | None = None,
                    genres_second: Sequence[str] | None = None, change: str = "all",
                    labels: Sequence[str] = S.PERIOD_LABELS) -> DataFrame:
    """Genre filters and the three-way change filter (all/unchanged/changed).

    "changed" is null-safe: a NULL label counts as changed.
    """
    a, b = labels[0], labels[-1]
    df = filter_in(search, **{f"Genre_{a}": genres_first, f"Genre_{b}": genres_second})
    if "Changing" not in df.columns:  # an older table: the filter is not offered
        return df
    if change == "unchanged":
        df = df.filter(F.col("Changing") == S.NO_CHANGE)
    elif change == "changed":
        df = df.filter(~F.col("Changing").eqNullSafe(S.NO_CHANGE))
    elif change != "all":
        raise ValueError("change must be 'all', 'unchanged' or 'changed'")
    return df


def filter_options(rfm: DataFrame, content: DataFrame, search: DataFrame) -> DataFrame:
    """Distinct non-NULL values offered by each dashboard filter.

    Each table is read once: its filter columns are unpivoted into
    (filter, value) pairs and de-duplicated together.
    """
    def options(df: DataFrame, cols: Sequence[str]) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("filter"), F.col(c).cast("string").alias("value")) for c in cols])
        return df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()

    return (options(rfm, ["Segment"]).unionByName(options(content, ["MostWatch", "Active"]))
            .unionByName(options(search, ["Genre_T6", "Genre_T7"])).orderBy("filter", "value"))


def search_kpis(search: DataFrame) -> DataFrame:
    """Users, genres of each month, and (only if the table has the change column) the unchanged share."""
    n = F.count(F.lit(1))
    kpis = [n.alias("users"), F.count_distinct("Genre_T6").alias("genres_t6"), F.count_distinct("Genre_T7").alias("genres_t7")]
    if "Changing" in search.columns:
        share = ratio(F.count_if(F.col("Changing") == S.NO_CHANGE) * F.lit(100), n)
        kpis.append(F.coalesce(share, F.lit(0.0)).alias("no_change_pct"))
    return search.agg(*kpis)


def genre_counts(search: DataFrame, col: str) -> DataFrame:
    return value_counts(search.select(F.col(col).alias("Genre")), "Genre")


def genre_compare(search: DataFrame) -> DataFrame:
    """Genre, T6, T7 counts (0 where a genre occurs in one month only).

    Both genre columns are unpivoted and counted in one aggregate, instead
    of a full outer join of two count tables.
    """
    long = search.select(F.inline(F.array(
        F.struct(F.lit(1).alias("side"), F.col("Genre_T6").alias("Genre")),
        F.struct(F.lit(2).alias("side"), F.col("Genre_T7").alias("Genre")))))
    return (long.filter(F.col("Genre").isNotNull()).groupBy("Genre")
            .agg(F.count_if(F.col("side") == 1).alias("T6"), F.count_if(F.col("side") == 2).alias("T7"))
            .orderBy(F.desc("T6"), "Genre"))


def change_status(search: DataFrame) -> DataFrame:
    st = search.select(L.change_status(F.col("Changing")).alias("Status"))
    return with_share(_counts(st, "Status"))


def top_changing(search: DataFrame, k: int = 15) -> DataFrame:
    return top_k(search, "Changing", k)


def top_keywords(search: DataFrame, col: str, k: int = 15) -> DataFrame:
    return top_k(search.select(F.col(col).alias("Keyword")), "Keyword", k)


def genre_matrix(search: DataFrame) -> DataFrame:
    """Long form: Genre_T6, Genre_T7, Count (pairs that occur)."""
    return (search.filter(F.col("Genre_T6").isNotNull() & F.col("Genre_T7").isNotNull())
            .groupBy("Genre_T6", "Genre_T7").agg(F.count(F.lit(1)).alias("Count")))


def genre_matrix_wide(search: DataFrame, genres: Sequence[str] = S.GENRES) -> DataFrame:
    """Wide form: one row per first-month genre, one column per genre of
    the closed label set (pinned, so the schema never depends on the data),
    missing pairs 0."""
    return matrix_wide(genre_matrix(search), genres)


def matrix_wide(pairs: DataFrame, genres: Sequence[str] = S.GENRES) -> DataFrame:
    cols = [F.coalesce(F.sum(F.when(F.col("Genre_T7") == g, F.col("Count"))), F.lit(0)).cast("long").alias(g)
            for g in genres]
    return pairs.groupBy("Genre_T6").agg(*cols)


def genre_flow(search: DataFrame, k: int = 20) -> DataFrame:
    """The k largest genre -> genre flows; ties by the genre pair."""
    return flows(genre_matrix(search), k)


def flows(pairs: DataFrame, k: int) -> DataFrame:
    return (pairs.orderBy(F.col("Count").desc(), "Genre_T6", "Genre_T7").limit(k)
            .withColumnRenamed("Count", "count"))


def _ranked_flow(pairs: DataFrame, k: int) -> DataFrame:
    # At most k rows: a global window here is bounded by k.
    w = Window.orderBy(F.col("count").desc(), "Genre_T6", "Genre_T7")
    return flows(pairs, k).withColumn("_rank", F.row_number().over(w))


def _indexed_flows(pairs: DataFrame, k: int) -> DataFrame:
    """Ranked flows with node indexes, all by windows over at most k rows.

    A first-month label's index is its order of first appearance among the
    ranked flows; second-month labels follow after all first-month labels.
    """
    f = _ranked_flow(pairs, k)
    f = (f.withColumn("_f6", F.min("_rank").over(Window.partitionBy("Genre_T6")))
         .withColumn("_f7", F.min("_rank").over(Window.partitionBy("Genre_T7"))))
    f = (f.withColumn("source", (F.dense_rank().over(Window.orderBy("_f6")) - F.lit(1)).cast("long"))
         .withColumn("_t7", (F.dense_rank().over(Window.orderBy("_f7")) - F.lit(1)).cast("long")))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return f.withColumn("target", F.max("source").over(everything) + F.lit(1) + F.col("_t7"))


def genre_flow_nodes(search: DataFrame, k: int = 20) -> DataFrame:
    """Node labels "<genre> (T6)" then "<genre> (T7)", each group in order of
    first appearance among the ranked flows; node_index counts from 0."""
    return flow_nodes(genre_matrix(search), k)


def flow_nodes(pairs: DataFrame, k: int) -> DataFrame:
    f = _indexed_flows(pairs, k)
    nodes = F.array(
        F.struct(F.col("source").alias("node_index"), F.concat(F.col("Genre_T6"), F.lit(" (T6)")).alias("label")),
        F.struct(F.col("target").alias("node_index"), F.concat(F.col("Genre_T7"), F.lit(" (T7)")).alias("label")))
    return f.select(F.inline(nodes)).distinct()


def genre_flow_links(search: DataFrame, k: int = 20) -> DataFrame:
    """Flows with node indexes: source, target, value."""
    return flow_links(genre_matrix(search), k)


def flow_links(pairs: DataFrame, k: int) -> DataFrame:
    return _indexed_flows(pairs, k).select("source", "target", F.col("count").alias("value"))


# ── inspection and guards ──────────────────────────────────────────────────


class ResultTableError(ValueError):
    """A result table is missing or lacks required columns."""


def require_columns(df: DataFrame, columns: Sequence[str], table: str = "result") -> DataFrame:
    """Raise a clear error when required columns are missing (case-sensitive)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ResultTableError(f"{table}: missing columns {missing}; present: {df.columns}")
    return df


def is_empty(df: DataFrame) -> bool:
    """True when the table has no rows (reads at most one row)."""
    return df.isEmpty()


def require_rows(df: DataFrame, table: str = "result") -> DataFrame:
    """Raise when the table has no rows."""
    if is_empty(df):
        raise ResultTableError(f"{table}: no rows")
    return df


def preview(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    """The first n rows in a stable order (a top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(n)
