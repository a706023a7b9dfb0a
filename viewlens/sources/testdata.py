"""Adapters from the shared benchmark tables to the pipelines' inputs.

The pipelines consume viewing logs, search logs and transactions. The
benchmark folder holds TPC-H-like tables plus an event stream; these
functions derive the pipelines' inputs from them with plain projections,
filters and joins so Catalyst can prune columns and push filters into the
Parquet scans.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapters (shared with the SQL oracle).
EVENT_APP_NAMES = {"view": "KPLUS", "click": "VOD", "signup": "SPORT", "error": "UNKNOWN_APP"}
PURCHASE_APP_EVEN, PURCHASE_APP_ODD = "RELAX", "CHILD"
# All orders before this date are the first period, all others the second.
SEARCH_SECOND_PERIOD_START = dt.date(1998, 5, 1)
PART_GENRES = {
    "bolt": "Action", "anvil": "Drama", "ring": "Romance", "gear": "Sports",
    "widget": "TV Channel", "rod": "News", "plate": "Music",
}
PART_GENRE_ELSE = "Comedy"
# Month 1 labels every name not starting with "old", month 2 every name not
# starting with "new" (so "old ..." names are labelled in month 2 only).
MAPPING_EXCLUDED_FIRST_WORDS = {1: ["old"], 2: ["new"]}
MAPPING_OTHER_FIRST_WORDS = {1: [], 2: ["red"]}
# Some parts are searched by other keywords than their name: worked examples as they are, names with a hint word,
# names of nations and regions; by part key modulo KEYWORD_CYCLE, the rest by part name.
KEYWORD_CYCLE = 24
KEYWORD_EXAMPLES = ["thuyếtminh", "bigfoot", "capdoi", "ARGEN", "nhật ký", "PENT", "running", "VTV3"]
KEYWORD_PREFIXES = ["HTV7 ", "Reality ", "LOVE ", "Harry Potter ", "Phim Việt ", "phim trung ", "PHIM HÀN "]
CONTENT_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 6))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> (Transaction_ID, CustomerID, Purchase_Date, GMV)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        o.o_orderkey.cast("string").alias("Transaction_ID"),
        o.o_custkey.alias("CustomerID"),
        o.o_orderdate.cast("date").alias("Purchase_Date"),
        o.o_totalprice.cast("decimal(18,2)").alias("GMV"),
    )


def _app_name() -> F.Column:
    et = F.col("event_type")
    expr = F.when(et == "purchase", F.when(F.col("event_id") % 2 == 0, PURCHASE_APP_EVEN).otherwise(PURCHASE_APP_ODD))
    for event, app in EVENT_APP_NAMES.items():
        expr = expr.when(et == event, app)
    return expr


def content_log(spark: SparkSession, sf_dir: str, start: dt.date | None = None,
                end: dt.date | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """events -> flat viewing log (Contract, Mac, AppName, TotalDuration, Process_Date), and ``extra`` columns of events.

    The day range is applied on the raw timestamp so it reaches the scan as
    a pushed filter.
    """
    ev = table(spark, sf_dir, "events")
    if start is not None:
        ev = ev.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        ev = ev.filter(F.col("ts") < F.lit(end + dt.timedelta(days=1)).cast("timestamp_ntz"))
    return ev.select(
        F.col("user_id").cast("string").alias("Contract"),
        F.get_json_object("props", "$.k").alias("Mac"),
        _app_name().alias("AppName"),
        (F.col("value").cast("decimal(18,2)") * 100).cast("long").alias("TotalDuration"),
        F.col("ts").cast("date").alias("Process_Date"),
        *extra,
    )


def content_log_nested(spark: SparkSession, sf_dir: str, start: dt.date | None = None,
                       end: dt.date | None = None) -> DataFrame:
    """The flat log nested under ``_source`` as the raw JSON lines carry it."""
    flat = content_log(spark, sf_dir, start, end)
    return flat.select(
        F.struct("Contract", "Mac", "AppName", "TotalDuration").alias("_source"),
        "Process_Date",
    )


def _part_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> (p_partkey, keyword)."""
    k, turn = F.col("p_partkey") % KEYWORD_CYCLE, F.floor(F.col("p_partkey") / KEYWORD_CYCLE).cast("long")
    keyword = F.when(k == -1, F.lit(""))
    for i, word in enumerate(KEYWORD_EXAMPLES):
        keyword = keyword.when(k == i, word)
    for i, prefix in enumerate(KEYWORD_PREFIXES, start=len(KEYWORD_EXAMPLES)):
        keyword = keyword.when(k == i, F.concat(F.lit(prefix), F.col("p_name")))
    keyword = keyword.when(k == 15, F.col("n_name")).when(k == 16, F.col("r_name")).otherwise(F.col("p_name"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long"), "n_name")
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long"), "r_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name").withColumns({"_n": turn % 25, "_r": turn % 5})
    return (p.join(nations, F.col("_n") == F.col("n_nationkey"), "left").join(regions, F.col("_r") == F.col("r_regionkey"), "left")
            .select("p_partkey", keyword.alias("keyword")))


def known_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, Genre): countries are Sports, regions News."""
    return (table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.lit("Sports").alias("Genre"))
            .unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.lit("News").alias("Genre"))))


def _genre_of_name(name: F.Column) -> F.Column:
    second = F.get(F.split(name, " "), F.lit(1))
    expr = None
    for word, genre in PART_GENRES.items():
        expr = F.when(second == word, genre) if expr is None else expr.when(second == word, genre)
    return expr.otherwise(PART_GENRE_ELSE)


def keyword_mapping(spark: SparkSession, sf_dir: str, period: int) -> DataFrame:
    """(keyword, Genre) labels of one period (the labeller's output)."""
    return keyword_mapping_tagged(spark, sf_dir).filter(F.col("period") == period).select("keyword", "Genre")


def search_log_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both periods in one scan: (period, user_id, keyword).

    Each line item is one search of its part's keyword by the order's
    customer; the order's date decides the period, so no order is left out.
    Join strategies are left to the optimizer.
    """
    second = F.col("o_orderdate") >= F.lit(SEARCH_SECOND_PERIOD_START).cast("timestamp_ntz")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(second, 2).otherwise(1).alias("period"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = _part_keywords(spark, sf_dir)
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(p, li.l_partkey == p.p_partkey)
            .select("period", F.col("o_custkey").cast("string").alias("user_id"), "keyword"))


def keyword_mapping_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both periods' labels: (period, keyword, Genre), from one scan of part.

    Distinct keywords first, then each yields one row per period whose
    rules admit it.
    """
    name = F.col("keyword")
    first = F.split(name, " ").getItem(0)
    rows = []
    for period in (1, 2):
        genre = _genre_of_name(name)
        for w in MAPPING_OTHER_FIRST_WORDS[period]:
            genre = F.when(first == w, "Other").otherwise(genre)
        keep = ~first.isin(MAPPING_EXCLUDED_FIRST_WORDS[period])
        rows.append(F.when(keep, F.struct(F.lit(period).alias("period"), genre.alias("Genre"))))
    names = _part_keywords(spark, sf_dir).select("keyword").distinct()
    return (names.select("keyword", F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("_r"))
            .select(F.col("_r.period").alias("period"), "keyword", F.col("_r.Genre").alias("Genre")))


def search_log_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole search log by day: (day, user_id, keyword). The first period's searches lie in June 2022, the second's in July,
    on the order date's day of the month (the 31st in June: the 30th)."""
    second = F.col("o_orderdate") >= F.lit(SEARCH_SECOND_PERIOD_START).cast("timestamp_ntz")
    dom = F.dayofmonth("o_orderdate")
    day = F.when(second, F.make_date(F.lit(2022), F.lit(7), dom)).otherwise(F.make_date(F.lit(2022), F.lit(6), F.least(dom, F.lit(30))))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", day.alias("day"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = _part_keywords(spark, sf_dir)
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
            .select("day", F.col("o_custkey").cast("string").alias("user_id"), "keyword"))


SEARCH_MONTHS = {1: (dt.date(2022, 6, 1), dt.date(2022, 6, 30)), 2: (dt.date(2022, 7, 1), dt.date(2022, 7, 31))}


#: Events of these remainders by 50 become broken lines of the viewing log.
BROKEN_CYCLE, TRUNCATED, NO_SOURCE, WRONG_TYPE = 50, 7, 8, 9


def content_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (day, line): the viewing log's JSON lines, some of them broken."""
    flat = content_log(spark, sf_dir, extra=["event_id"])
    who, k = F.coalesce("Contract", F.lit("")), F.col("event_id") % BROKEN_CYCLE
    good = F.to_json(F.struct(F.struct("Contract", "Mac", "AppName", "TotalDuration").alias("_source")))
    line = (F.when(k == TRUNCATED, F.concat(F.lit('{"_source": {"Contract": "'), who, F.lit('", "event": '), "event_id"))
            .when(k == NO_SOURCE, F.concat(F.lit('{"_other": {"event": '), "event_id", F.lit("}}")))
            .when(k == WRONG_TYPE, F.concat(F.lit('{"_source": {"Contract": "'), who, F.lit('", "TotalDuration": "much '), "event_id", F.lit('"}}')))
            .otherwise(good))
    return flat.select(F.date_format("Process_Date", "yyyyMMdd").alias("day"), line.alias("line"))
