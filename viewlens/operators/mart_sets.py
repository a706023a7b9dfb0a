"""All marts of a customer table from one aggregate over grouping sets.

One scan of the table groups by every key that a mart needs (and by nothing, for the totals) and keeps the sums and counts of
which the marts are made. Each mart is then read from the rows of its grouping set: a few rows, however large the table. The
functions of ``operators.marts`` give the same marts one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.functions import labels as L
from viewlens.functions.exact import ratio, ratio_half_even
from viewlens.operators import marts as M

ALL = "all"
RFM_SETS = {ALL: [], "segment": ["Segment"], "score": ["RFM_Score"]}
CONTENT_SETS = {ALL: [], "most_watch": ["MostWatch"], "active": ["Active"], "taste": ["Taste"], "most_watch_active": ["MostWatch", "Active"],
                "devices": ["Total_Devices"]}
SEARCH_SETS = {ALL: [], "t6": ["Genre_T6"], "t7": ["Genre_T7"], "pair": ["Genre_T6", "Genre_T7"], "keyword_t6": ["Most_Searched_T6"],
               "keyword_t7": ["Most_Searched_T7"]}
_DURATIONS = list(M._LABEL_COLUMN.items())


def _grouped(df: DataFrame, sets: Mapping[str, Sequence[str]], measures: Sequence[Column]) -> DataFrame:
    """A row per group of each set: the set's name, its keys (the others NULL), the measures."""
    keys = list(dict.fromkeys(k for s in sets.values() for k in s))
    name = None
    for s, its in sets.items():  # the grouping id has a bit per key, the first key's the highest; set where a key is left out
        gid = sum((k not in its) << (len(keys) - 1 - i) for i, k in enumerate(keys))
        name = F.when(F.col("_gid") == gid, s) if name is None else name.when(F.col("_gid") == gid, s)
    out = df.groupingSets([[F.col(k) for k in s] for s in sets.values()], *keys).agg(F.grouping_id().alias("_gid"), *measures)
    return out.withColumn("grouping", name).drop("_gid")


def _of(cube: DataFrame, grouping: str) -> DataFrame:
    return cube.filter(F.col("grouping") == grouping)


def _total(cube: DataFrame, *cols: Column) -> DataFrame:
    """One row from the totals; an empty table has none, and its sums are NULL, its counts 0."""
    return _of(cube, ALL).agg(*cols)


def _sum(c: str) -> Column:
    return F.sum(c)


def _n(c: str = "n") -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def _counted(cube: DataFrame, grouping: str, key: str, name: str | None = None) -> DataFrame:
    return _of(cube, grouping).filter(F.col(key).isNotNull()).select(F.col(key).alias(name or key), F.col("n").alias("Count"))


def _ranked(counts: DataFrame, k: int | None = None) -> DataFrame:
    out = counts.orderBy(F.desc("Count"), counts.columns[0])
    return out if k is None else out.limit(k)


def _measured(name: str, value: Column, of: str | None = None) -> list[Column]:
    """Sum of a value and the number of rows that have it."""
    return [F.sum(value).alias(f"s_{name}"), F.count(F.col(of or name)).alias(f"n_{name}")]


def rfm_sets(rfm: DataFrame) -> DataFrame:
    return _grouped(rfm, RFM_SETS, [
        F.count(F.lit(1)).alias("n"), F.count("CustomerID").alias("n_CustomerID"), *_measured("Recency", F.col("Recency")),
        *_measured("Frequency", F.col("Frequency")), *_measured("Monetary", M.money_cents("Monetary")), *_measured("AOV", F.col("AOV").cast("long"))])


def rfm_marts(cube: DataFrame) -> dict[str, DataFrame]:
    segment = _of(cube, "segment").filter(F.col("Segment").isNotNull())

    def mean1(c: str, unit: int = 1) -> Column:
        return ratio_half_even(F.col(f"s_{c}"), F.col(f"n_{c}") * F.lit(unit), 1)

    def mean(c: str, unit: int = 1) -> Column:
        return ratio(_sum(f"s_{c}"), _n(f"n_{c}") * F.lit(unit))

    cents = F.coalesce("s_Monetary", F.lit(0))
    counts = _counted(cube, "segment", "Segment")
    return {
        "rfm_kpis": _total(cube, _n().alias("customers"), mean("Recency").alias("avg_recency"), mean("Frequency").alias("avg_frequency"),
                           mean("Monetary", 100).alias("avg_monetary"), mean("AOV").alias("avg_aov")),
        "rfm_segment_counts": _ranked(counts),
        "rfm_segment_revenue": segment.select("Segment", (cents.cast("double") / F.lit(100.0)).alias("Revenue")).orderBy(F.desc("Revenue"), "Segment"),
        "rfm_segment_share": M.with_share(counts),
        "top_rfm_scores": _ranked(_counted(cube, "score", "RFM_Score"), 20),
        "rfm_segment_stats": segment.select(
            "Segment", F.col("n_CustomerID").alias("Customers"), mean1("Recency").alias("Avg_Recency"), mean1("Frequency").alias("Avg_Frequency"),
            mean1("Monetary", 100).alias("Avg_Monetary"), mean1("AOV").alias("Avg_AOV"),
            ratio_half_even(cents, F.lit(100), 1).alias("Total_Revenue")).orderBy(F.desc("Customers"), "Segment"),
    }


def content_sets(content: DataFrame) -> DataFrame:
    return _grouped(content, CONTENT_SETS, [
        F.count(F.lit(1)).alias("n"), F.count("Contract").alias("n_Contract"), F.count_if(F.col("Active") == "High").alias("high"),
        *_measured("Total_Devices", F.col("Total_Devices")), *[m for _, c in _DURATIONS for m in _measured(c, F.col(c))]])


def content_marts(cube: DataFrame) -> dict[str, DataFrame]:
    watched = _of(cube, "most_watch").filter(F.col("MostWatch").isNotNull())
    total = sum((_n(f"s_{c}") for _, c in _DURATIONS), F.lit(0))
    taste, active = _counted(cube, "taste", "Taste"), _counted(cube, "active", "Active")
    both = _of(cube, "most_watch_active").filter(F.col("MostWatch").isNotNull() & F.col("Active").isNotNull())
    return {
        "content_kpis": _total(cube, _n().alias("users"), F.coalesce(ratio(_n("high") * F.lit(100), _n()), F.lit(0.0)).alias("high_pct"),
                               F.coalesce(ratio(_sum("s_Total_Devices"), _n("n_Total_Devices")), F.lit(0.0)).alias("avg_devices"),
                               total.cast("long").alias("total_duration")),
        "content_durations": M._category_rows(_total(cube, *[_n(f"s_{c}").cast("long").alias(c) for _, c in _DURATIONS]), "Duration"),
        "content_most_watch": _ranked(_counted(cube, "most_watch", "MostWatch")),
        "content_active": M.with_share(active),
        "top_taste15": _ranked(taste, 15),
        "content_avg_durations": M._category_rows(_total(cube, *[ratio(_sum(f"s_{c}"), _n(f"n_{c}")).alias(c) for _, c in _DURATIONS]), "Avg_Duration"),
        "device_histogram": M.histogram_of_counts(_of(cube, "devices").filter(F.col("Total_Devices").isNotNull()).select("Total_Devices", F.col("n").alias("_n"))),
        "most_watch_active": both.select("MostWatch", "Active", F.col("n").alias("Count")).orderBy("MostWatch", "Active"),
        "top_taste20": _ranked(taste, 20),
        "most_watch_stats": watched.select(
            "MostWatch", F.col("n_Contract").alias("Users"), ratio_half_even(F.col("s_Total_Devices"), F.col("n_Total_Devices"), 1).alias("Avg_Devices"),
            *[ratio_half_even(F.col(f"s_{c}"), F.col(f"n_{c}"), 1).alias("Avg_" + c[len("Total_"):]) for _, c in _DURATIONS],
            ratio_half_even(F.col("high") * F.lit(100), F.col("n"), 1).alias("High_Pct")).orderBy(F.desc("Users"), "MostWatch"),
    }


def search_sets(search: DataFrame) -> DataFrame:
    sets = SEARCH_SETS | ({"changing": ["Changing"]} if "Changing" in search.columns else {})
    return _grouped(search, sets, [F.count(F.lit(1)).alias("n")])


def search_marts(cube: DataFrame) -> dict[str, DataFrame]:
    sides = {"T6": _counted(cube, "t6", "Genre_T6", "Genre"), "T7": _counted(cube, "t7", "Genre_T7", "Genre")}
    pairs = _of(cube, "pair").filter(F.col("Genre_T6").isNotNull() & F.col("Genre_T7").isNotNull())
    pairs = pairs.select("Genre_T6", "Genre_T7", F.col("n").alias("Count"))
    compared = _of(cube, "t6").select(F.col("Genre_T6").alias("Genre"), F.col("n").alias("T6"), F.lit(0).alias("T7")).unionByName(
        _of(cube, "t7").select(F.col("Genre_T7").alias("Genre"), F.lit(0).alias("T6"), F.col("n").alias("T7"))).filter(F.col("Genre").isNotNull())
    def of(grouping: str) -> Column:
        return F.col("grouping") == grouping

    kpis = [F.coalesce(F.sum(F.when(of(ALL), F.col("n"))), F.lit(0)).alias("users"),
            F.count_if(of("t6") & F.col("Genre_T6").isNotNull()).alias("genres_t6"),
            F.count_if(of("t7") & F.col("Genre_T7").isNotNull()).alias("genres_t7")]
    out = {
        "genre_t6": _ranked(sides["T6"]), "genre_t7": _ranked(sides["T7"]),
        "genre_compare": compared.groupBy("Genre").agg(F.sum("T6").alias("T6"), F.sum("T7").alias("T7")).orderBy(F.desc("T6"), "Genre"),
        "top_keywords_t6": _ranked(_counted(cube, "keyword_t6", "Most_Searched_T6", "Keyword"), 15),
        "top_keywords_t7": _ranked(_counted(cube, "keyword_t7", "Most_Searched_T7", "Keyword"), 15),
        "genre_matrix": pairs, "genre_matrix_wide": M.matrix_wide(pairs), "genre_flow": M.flows(pairs, 20),
        "genre_flow_nodes": M.flow_nodes(pairs, 20), "genre_flow_links": M.flow_links(pairs, 20),
    }
    if "Changing" in cube.columns:
        same = F.coalesce(F.sum(F.when(of("changing") & (F.col("Changing") == S.NO_CHANGE), F.col("n"))), F.lit(0))
        users = F.sum(F.when(of(ALL), F.col("n")))
        kpis.append(F.coalesce(ratio(same * F.lit(100), users), F.lit(0.0)).alias("no_change_pct"))
        status = _of(cube, "changing").groupBy(L.change_status(F.col("Changing")).alias("Status")).agg(F.sum("n").alias("Count"))
        out |= {"change_status": M.with_share(status), "top_changing": _ranked(_counted(cube, "changing", "Changing"), 15)}
    return out | {"search_kpis": cube.agg(*kpis)}


def counts(cube: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """(mart, key, key2, Count): the rows of every grouping set in one table; groups with a NULL key are left out, as in the marts."""
    def keys(pick: Callable[[Sequence[str]], str | None]) -> Column:
        out = F.lit(None).cast("string")
        for s, its in sets.items():
            if (k := pick(its)) is not None:
                out = F.when(F.col("grouping") == s, F.col(k).cast("string")).otherwise(out)
        return out

    long = cube.select(F.col("grouping").alias("mart"), keys(lambda s: s[0] if s else None).alias("key"),
                       keys(lambda s: s[1] if len(s) > 1 else None).alias("key2"), F.col("n").alias("Count"))
    whole = F.lit(False)
    for s, its in sets.items():
        here = F.col("mart") == s
        for c in ("key", "key2")[:len(its)]:
            here = here & F.col(c).isNotNull()
        whole = whole | here
    return long.filter(whole)
