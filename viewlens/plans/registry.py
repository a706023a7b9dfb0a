"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the benchmark tables (through the adapters in
``viewlens.sources.testdata``) and runs over all of their rows; only
``content_profile_range``, ``content_range_scan`` and ``search_period_scan``
read a part, since pruning is what they show.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.operators import classify as K
from viewlens.operators import content as C
from viewlens.operators import mart_sets as G
from viewlens.operators import marts as M
from viewlens.operators import rfm as R
from viewlens.operators import search as Q
from viewlens.operators.ntile import global_ntiles
from viewlens.plans import content as content_plan
from viewlens.plans import devices as device_plan
from viewlens.plans import rfm as rfm_plan
from viewlens.plans import search as search_plan
from viewlens.plans import search_state
from viewlens.plans.refresh import refresh_daily
from viewlens.plans.search_tables import change_from_tables, save_search_tables
from viewlens.session import scratch_path, stored
from viewlens.sources import files
from viewlens.sources import testdata as TD
from viewlens.sources.publish import append_once, publish, read_runs
from viewlens.sources.sinks import write_content_log, write_csv, write_parquet
from viewlens.streaming.content_daily import profile_from_daily, read_daily_profiles, start_daily_profiles
from viewlens.streaming.search_daily import start_daily_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def iso(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


# ── RFM ────────────────────────────────────────────────────────────────────

@query("rfm_clean")
def rfm_clean(spark, sf):
    c = R.clean(TD.transactions(spark, sf))
    return c.select("Transaction_ID", "CustomerID", iso("Purchase_Date"), F.col("GMV").cast("double").alias("GMV"))


@query("rfm_clean_audit")
def rfm_clean_audit(spark, sf):
    return R.clean_audit(TD.transactions(spark, sf))


@query("rfm_run_audit")
def rfm_run_audit(spark, sf):
    """The audit that the scoring run itself observes, without a scan of its own."""
    _, audit = rfm_plan.rfm_table_audited(TD.transactions(spark, sf))
    return spark.createDataFrame([tuple(audit.values())], "rows_before long, rows_after long, rows_removed long, customers long")


@query("rfm_segments_audited")
def rfm_segments_audited(spark, sf):
    """The result table of the audited run."""
    return rfm_plan.rfm_table_audited(TD.transactions(spark, sf))[0]


@query("rfm_base")
def rfm_base(spark, sf):
    b = rfm_plan.rfm_base(TD.transactions(spark, sf))
    return b.select("CustomerID", "Recency", "Frequency", F.col("Monetary").cast("double").alias("Monetary"), "AOV")


@query("rfm_scores")
def rfm_scores(spark, sf):
    s = rfm_plan.rfm_scores(TD.transactions(spark, sf))
    return s.select("CustomerID", "Recency", "Frequency", F.col("Monetary").cast("double").alias("Monetary"), "AOV",
                    "R_Score", "F_Score", "M_Score", "RFM_Score")


@query("rfm_segments")
def rfm_segments(spark, sf):
    return rfm_plan.rfm_table(TD.transactions(spark, sf))


@query("rfm_segment_counts")
def rfm_segment_counts(spark, sf):
    return R.segment_counts(rfm_plan.rfm_table(TD.transactions(spark, sf)))


@query("global_ntile")
def global_ntile_query(spark, sf):
    """Seven tiles over a near-unique and a heavily tied key, in shared passes."""
    totals = rfm_plan.customer_totals(TD.transactions(spark, sf))
    t = global_ntiles(totals, {"tile": "Monetary", "tile_frequency": "Frequency"}, 7, "CustomerID")
    return t.select("CustomerID", F.col("Monetary").cast("double").alias("Monetary"), "tile", "tile_frequency")


# ── Content ────────────────────────────────────────────────────────────────

def _flat(spark, sf, days=None):
    start, end = days if days else (None, None)
    return TD.content_log(spark, sf, start, end)


def _day_cols(df, *cols):
    return df.select("Contract", iso("Process_Date"), *cols)


@query("content_categorize")
def content_categorize(spark, sf):
    c = C.categorize(_flat(spark, sf))
    return c.select("Contract", "Mac", "AppName", "TotalDuration", iso("Process_Date"), "Type")


@query("content_daily_devices")
def content_daily_devices(spark, sf):
    return _day_cols(C.daily_devices(C.valid_views(_flat(spark, sf))), "Total_Devices")


@query("content_daily_durations")
def content_daily_durations(spark, sf):
    return _day_cols(C.daily_durations(C.valid_views(_flat(spark, sf))), "Type", "Total_Duration")


@query("content_daily_pivot")
def content_daily_pivot(spark, sf):
    return _day_cols(C.daily_pivot(C.valid_views(_flat(spark, sf))), *S.duration_columns())


@query("content_daily_profile")
def content_daily_profile(spark, sf):
    return _day_cols(C.daily_profile(C.valid_views(_flat(spark, sf))), "Total_Devices", *S.duration_columns())


@query("content_most_watch")
def content_most_watch(spark, sf):
    return _day_cols(content_plan.content_daily(_flat(spark, sf)), *S.duration_columns(), "MostWatch")


@query("content_taste")
def content_taste(spark, sf):
    return _day_cols(content_plan.content_daily(_flat(spark, sf)), *S.duration_columns(), "Taste")


@query("content_activity")
def content_activity(spark, sf):
    return C.activity(C.valid_views(_flat(spark, sf)))


@query("content_profile")
def content_profile(spark, sf):
    return content_plan.content_table(_flat(spark, sf))


@query("content_profile_range")
def content_profile_range(spark, sf):
    """Days 2024-01-01..06: a range where both activity labels occur."""
    return content_plan.content_table(_flat(spark, sf, TD.CONTENT_DAYS))


@query("content_profile_period")
def content_profile_period(spark, sf):
    return content_plan.content_table(_flat(spark, sf), labels="period")


@query("content_distinct_devices")
def content_distinct_devices(spark, sf):
    return C.distinct_devices(C.valid_views(_flat(spark, sf)))


# Files a partitioned write makes per day or period.
FILES_PER_DAY = 2


def _device_state(spark, sf):
    """The device state of the whole log: odd and even days fed apart, the even ones twice."""
    base, valid = scratch_path(spark, "devices"), C.valid_views(_flat(spark, sf))
    even = F.dayofmonth("Process_Date") % 2 == 0
    for part in (~even, even, even):
        device_plan.add_days(valid.filter(part), base, FILES_PER_DAY)
    return base


@query("content_devices_from_days")
def content_devices_from_days(spark, sf):
    """Distinct devices of the whole log from the stored bitmaps of its days."""
    return device_plan.distinct_devices(spark, _device_state(spark, sf))


@query("content_devices_of_range")
def content_devices_of_range(spark, sf):
    """Distinct devices of 2024-01-01..06 from the stored bitmaps."""
    return device_plan.distinct_devices(spark, _device_state(spark, sf), *TD.CONTENT_DAYS)


@query("content_daily_files")
def content_daily_files(spark, sf):
    """The whole log as <yyyymmdd>.json day files, all days of a longer range read back."""
    base = scratch_path(spark, "content-days")
    write_content_log(_flat(spark, sf), base, layout="daily_files", files_per_day=FILES_PER_DAY)
    got = files.content_range_scan(spark, base, dt.date(2023, 12, 1), dt.date(2024, 12, 31))
    return got.select("Contract", "Mac", "AppName", "TotalDuration", iso("Process_Date"))


@query("content_range_scan")
def content_range_scan(spark, sf):
    """Write the whole log as day folders of JSON, read back a day range."""
    base = scratch_path(spark, "content-log")
    write_content_log(_flat(spark, sf), base, layout="partitioned", files_per_day=FILES_PER_DAY)
    start, end = TD.CONTENT_DAYS
    got = files.content_range_scan(spark, base, start, end, layout="partitioned")
    return got.select("Contract", "Mac", "AppName", "TotalDuration", iso("Process_Date"))


# ── Search ─────────────────────────────────────────────────────────────────

def _search_inputs(spark, sf):
    return TD.search_log_tagged(spark, sf), TD.keyword_mapping_tagged(spark, sf)


@query("search_counts")
def search_counts(spark, sf):
    return Q.counts(TD.search_log_tagged(spark, sf))


@query("search_top_keyword")
def search_top_keyword(spark, sf):
    return Q.top_keyword(TD.search_log_tagged(spark, sf))


@query("search_top_keyword_incremental")
def search_top_keyword_incremental(spark, sf):
    """Top keywords from the stored counts of days that are fed in four parts, the third of them twice."""
    log, base = TD.search_log_days(spark, sf), scratch_path(spark, "search-state")
    for part in (0, 1, 2, 3, 2):
        search_state.add_days(log.filter(F.dayofmonth("day") % 4 == part), base, FILES_PER_DAY)
    return search_state.top_keyword(spark, base, TD.SEARCH_MONTHS)


@query("search_top_keyword_stream")
def search_top_keyword_stream(spark, sf):
    """Day folders of the whole log ingested by a file stream into the stored counts, then the top keywords."""
    src, state, ckpt = (scratch_path(spark, f"search-{name}") for name in ("days", "state", "ckpt"))
    log = TD.search_log_days(spark, sf).withColumn("day", F.date_format("day", "yyyyMMdd"))
    write_parquet(log, src, partition_by=["day"], files_per_partition=FILES_PER_DAY)
    start_daily_counts(spark, src, state, ckpt, files_per_day=FILES_PER_DAY).awaitTermination()
    return search_state.top_keyword(spark, state, TD.SEARCH_MONTHS)


@query("search_distinct_keywords")
def search_distinct_keywords(spark, sf):
    return Q.distinct_keywords(TD.search_log_tagged(spark, sf))


@query("search_keyword_popularity")
def search_keyword_popularity(spark, sf):
    return Q.keyword_popularity(Q.top_keyword(TD.search_log_tagged(spark, sf)), 20)


@query("search_mapped")
def search_mapped(spark, sf):
    log, mapping = _search_inputs(spark, sf)
    return Q.mapped(Q.top_keyword(log), mapping)


@query("genre_dimension")
def genre_dimension(spark, sf):
    return Q.genre_dimension(TD.keyword_mapping_tagged(spark, sf)).select("keyword", "Genre")


@query("search_period_pivot")
def search_period_pivot(spark, sf):
    log, mapping = _search_inputs(spark, sf)
    return Q.period_pivot(Q.mapped(Q.top_keyword(log), mapping))


@query("search_genre_enrich")
def search_genre_enrich(spark, sf):
    log, mapping = _search_inputs(spark, sf)
    pivot = Q.period_pivot(Q.mapped(Q.top_keyword(log), mapping))
    return Q.genre_enrich(pivot, Q.genre_dimension(mapping))


@query("search_changing")
def search_changing(spark, sf):
    log, mapping = _search_inputs(spark, sf)
    return search_plan.search_change(log, mapping)


@query("search_changing_salted")
def search_changing_salted(spark, sf):
    """The change table with the keyword join salted over 16 buckets."""
    log, mapping = _search_inputs(spark, sf)
    return search_plan.search_change(log, mapping, salt_buckets=16)


@query("search_changing_bucketed")
def search_changing_bucketed(spark, sf):
    """The change table from catalog tables bucketed by keyword."""
    log, mapping = _search_inputs(spark, sf)
    folder = scratch_path(spark, "search-tables")
    names = [f"{name}_{folder[-32:]}" for name in ("top_keywords", "keyword_genres")]
    save_search_tables(log, mapping, *names, folder, buckets=8)
    return change_from_tables(spark, *names)


@query("search_normalize")
def search_normalize(spark, sf):
    """A loaded copy with lower-case headers and padded strings, normalised back."""
    log, mapping = _search_inputs(spark, sf)
    res = search_plan.search_change(log, mapping)
    messy = res.select(*[F.concat(F.lit(" "), F.col(c), F.lit("  ")).alias(c.lower()) if c != "user_id"
                         else F.col(c) for c in res.columns])
    return Q.normalize(messy)


@query("search_period_scan")
def search_period_scan(spark, sf):
    """Write the log partitioned by period; read one period back (pruned)."""
    base = scratch_path(spark, "search-log")
    write_parquet(TD.search_log_tagged(spark, sf), base, partition_by=["period"], files_per_partition=8)
    return files.read_search_log(spark, base, period=1)


# ── Marts ──────────────────────────────────────────────────────────────────
# Fixed filter selections of the *_filtered keys.
RFM_FILTER_SEGMENTS = ["Champions", "Loyal Customers", "At Risk", "Hibernating"]
CONTENT_FILTER_MOST_WATCH = ["Truyền Hình", "Phim Truyện", "Thể Thao"]
CONTENT_FILTER_ACTIVE = ["Low"]
SEARCH_FILTER_GENRES_T6 = ["Action", "Drama", "Romance", "Sports", "Comedy"]
# Active days above which a contract is High in the marts: both labels occur over the log's 30 days.
MART_ACTIVE_DAYS = 26
SEARCH_FILTER_GENRES_T7 = ["Action", "Drama", "Romance", "Music", "Other"]


def _rfm(spark, sf):
    return rfm_plan.rfm_table(TD.transactions(spark, sf))


def _content(spark, sf):
    return content_plan.content_table(_flat(spark, sf), threshold=MART_ACTIVE_DAYS)


def _search(spark, sf):
    log, mapping = _search_inputs(spark, sf)
    return search_plan.search_change(log, mapping)


_MARTS = {
    "mart_rfm_filtered": (_rfm, lambda t: M.rfm_filtered(t, RFM_FILTER_SEGMENTS)),
    "mart_rfm_kpis": (_rfm, M.rfm_kpis),
    "mart_rfm_segment_counts": (_rfm, M.rfm_segment_counts),
    "mart_rfm_segment_revenue": (_rfm, M.rfm_segment_revenue),
    "mart_rfm_segment_share": (_rfm, M.rfm_segment_share),
    "mart_top_rfm_scores": (_rfm, lambda t: M.top_rfm_scores(t, 20)),
    "mart_rfm_segment_stats": (_rfm, M.rfm_segment_stats),
    "mart_content_filtered": (_content, lambda t: M.content_filtered(t, CONTENT_FILTER_MOST_WATCH,
                                                                     CONTENT_FILTER_ACTIVE)),
    "mart_content_kpis": (_content, M.content_kpis),
    "mart_content_durations": (_content, M.content_durations),
    "mart_content_most_watch": (_content, M.content_most_watch),
    "mart_content_active": (_content, M.content_active),
    "mart_top_taste15": (_content, lambda t: M.top_taste(t, 15)),
    "mart_content_avg_durations": (_content, M.content_avg_durations),
    "mart_device_histogram": (_content, M.device_histogram),
    "mart_most_watch_active": (_content, M.most_watch_active),
    "mart_top_taste20": (_content, lambda t: M.top_taste(t, 20)),
    "mart_most_watch_stats": (_content, M.most_watch_stats),
    "mart_search_filtered": (_search, lambda t: M.search_filtered(t, SEARCH_FILTER_GENRES_T6,
                                                                   SEARCH_FILTER_GENRES_T7)),
    "mart_search_changed": (_search, lambda t: M.search_filtered(t, change="changed")),
    "mart_search_kpis": (_search, M.search_kpis),
    "mart_genre_t6": (_search, lambda t: M.genre_counts(t, "Genre_T6")),
    "mart_genre_t7": (_search, lambda t: M.genre_counts(t, "Genre_T7")),
    "mart_genre_compare": (_search, M.genre_compare),
    "mart_change_status": (_search, M.change_status),
    "mart_top_changing": (_search, lambda t: M.top_changing(t, 15)),
    "mart_top_keywords_t6": (_search, lambda t: M.top_keywords(t, "Most_Searched_T6", 15)),
    "mart_top_keywords_t7": (_search, lambda t: M.top_keywords(t, "Most_Searched_T7", 15)),
    "mart_genre_matrix": (_search, M.genre_matrix),
    "mart_genre_matrix_wide": (_search, M.genre_matrix_wide),
    "mart_genre_flow": (_search, lambda t: M.genre_flow(t, 20)),
    "mart_genre_flow_nodes": (_search, lambda t: M.genre_flow_nodes(t, 20)),
    "mart_genre_flow_links": (_search, lambda t: M.genre_flow_links(t, 20)),
}


def _mart_query(source, fn):
    def run(spark, sf):
        return fn(source(spark, sf))
    return run


for _name, (_source, _fn) in _MARTS.items():
    QUERIES[_name] = _mart_query(_source, _fn)


@query("mart_counts_rfm")
def mart_counts_rfm(spark, sf):
    """All counts of the RFM marts from one aggregate over grouping sets."""
    return G.counts(G.rfm_sets(_rfm(spark, sf)), G.RFM_SETS)


@query("mart_counts_content")
def mart_counts_content(spark, sf):
    """All counts of the content marts from one aggregate."""
    return G.counts(G.content_sets(_content(spark, sf)), G.CONTENT_SETS)


@query("mart_counts_search")
def mart_counts_search(spark, sf):
    """All counts of the search marts from one aggregate."""
    return G.counts(G.search_sets(_search(spark, sf)), G.SEARCH_SETS | {"changing": ["Changing"]})


@query("mart_filter_options")
def mart_filter_options(spark, sf):
    return M.filter_options(_rfm(spark, sf), _content(spark, sf), _search(spark, sf))


# ── Keyword classification ─────────────────────────────────────────────────

@query("keyword_classify")
def keyword_classify(spark, sf):
    return K.classify_rules(TD.search_log_tagged(spark, sf), names=TD.known_names(spark, sf))


@query("keyword_classify_rules")
def keyword_classify_rules(spark, sf):
    return K.rule_hints(TD.search_log_tagged(spark, sf), TD.known_names(spark, sf))


@query("keyword_classify_batched")
def keyword_classify_batched(spark, sf):
    """A caller's function over batches: labels by keyword length, one of them outside the label set."""
    def by_length(words):
        return {w: ("Music", "Comedy", "Animation", "Not a genre")[len(w) % 4] for w in words}
    return K.classify_batched(TD.search_log_tagged(spark, sf), by_length, batch_size=100)


@query("keyword_classify_override")
def keyword_classify_override(spark, sf):
    """The first period's labels as an override table over the rules."""
    return K.classify_rules(TD.search_log_tagged(spark, sf), overrides=TD.keyword_mapping(spark, sf, 1),
                            names=TD.known_names(spark, sf))


@query("keyword_classify_incremental")
def keyword_classify_incremental(spark, sf):
    """First-period labels as the known table; only the other keywords go through the rules."""
    return K.classify_incremental(TD.search_log_tagged(spark, sf), TD.keyword_mapping(spark, sf, 1),
                                  names=TD.known_names(spark, sf))


@query("keyword_classify_resumed")
def keyword_classify_resumed(spark, sf):
    """A run that labels the keywords of even length, then one with another labeller over all: it is asked for the others only."""
    log, ledger = TD.search_log_tagged(spark, sf), scratch_path(spark, "labels")
    K.classify_resumable(log.filter(F.length("keyword") % 2 == 0), lambda words: ["Music"] * len(words), ledger, batch_size=100)
    return K.classify_resumable(log, lambda words: {w: "Comedy" for w in words}, ledger, batch_size=100)


@query("label_response_parse")
def label_response_parse(spark, sf):
    """An answer per keyword with its first-period label, well formed or broken in one of five ways, parsed back."""
    kw = K.distinct_keywords(TD.search_log_tagged(spark, sf)).join(TD.keyword_mapping(spark, sf, 1), "keyword", "left")
    q, entry = F.lit('"'), lambda label: F.concat(F.lit('"'), F.col("keyword"), F.lit('": "'), label, F.lit('"'))
    label = F.coalesce("Genre", F.lit("no such label"))
    good = F.concat(F.lit("{"), entry(label), F.lit("}"))
    forms = [good, F.concat(F.lit("Result: {"), entry(F.lit("Horror")), F.lit(", "), entry(label), F.lit("} -- done")),
             F.replace(good, q, F.lit("'")), F.concat(good, F.lit(" "), good), F.lit("no idea"),
             F.concat(F.lit('{"another keyword": "'), label, F.lit('"}')), F.concat(F.lit("{"), entry(label), F.lit(", }")),
             F.concat(F.lit("Sure! "), good, F.lit(" Anything else?"))]
    answers = kw.select(F.element_at(F.array(*forms), F.length("keyword") % len(forms) + 1).alias("response"),
                        F.array("keyword").alias("keywords"))
    return K.parse_responses(answers)


@query("keyword_preview")
def keyword_preview(spark, sf):
    """The first ten labelled keywords, as the labelling step shows them."""
    return M.preview(keyword_classify(spark, sf), ["keyword"], 10)


# ── Streaming ──────────────────────────────────────────────────────────────

@query("content_daily_stream")
def content_daily_stream(spark, sf):
    """Day folders of the whole log ingested by a file stream into daily profiles."""
    src = scratch_path(spark, "stream-src")
    write_content_log(_flat(spark, sf), src, layout="partitioned", files_per_day=FILES_PER_DAY)
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    q = start_daily_profiles(spark, src, sink, ckpt, layout="partitioned", available_now=True,
                             files_per_day=FILES_PER_DAY)
    q.awaitTermination()
    daily = read_daily_profiles(spark, sink)
    return daily.select("Contract", iso("Process_Date"), "Total_Devices", *S.duration_columns(), "MostWatch", "Taste")


@query("content_daily_refreshed")
def content_daily_refreshed(spark, sf):
    """Daily profiles by the file ledger: odd days, then a part of the even ones, the rest of these as late files, and a run without news."""
    src, sink, ledger = (scratch_path(spark, f"refresh-{name}") for name in ("src", "sink", "ledger"))
    flat, odd = _flat(spark, sf), F.dayofmonth("Process_Date") % 2 == 1
    late = ~odd & (F.pmod(F.xxhash64("Contract"), F.lit(3)) == 0)
    for part in (odd, ~odd & ~late, late, F.lit(False)):
        write_content_log(flat.filter(part), src, layout="partitioned", mode="append", files_per_day=FILES_PER_DAY)
        refresh_daily(spark, src, sink, ledger, "partitioned", FILES_PER_DAY)
    daily = read_daily_profiles(spark, sink)
    return daily.select("Contract", iso("Process_Date"), "Total_Devices", *S.duration_columns(), "MostWatch", "Taste")


# ── Pipelines from files in the original formats ───────────────────────────

@query("rfm_from_csv")
def rfm_from_csv(spark, sf):
    """Transactions written as header CSV in another column order with one column more, read back by header name."""
    path = scratch_path(spark, "transactions-csv")
    write_csv(TD.transactions(spark, sf).select("CustomerID", "GMV", F.lit("web").alias("Channel"), "Purchase_Date", "Transaction_ID"), path)
    return rfm_plan.rfm_table(files.read_transactions(spark, path))


@query("search_top_keyword_csv")
def search_top_keyword_csv(spark, sf):
    """Top keywords of both periods written as header CSV, read back as the labelling step reads them."""
    path = scratch_path(spark, "top-keywords")
    write_csv(Q.top_keyword(TD.search_log_tagged(spark, sf)).select("user_id", "keyword", "search_count"), path)
    return files.read_most_search(spark, path)


@query("search_from_files")
def search_from_files(spark, sf):
    """Month logs as Parquet day folders read by month glob; labels as per-user CSV files."""
    base = scratch_path(spark, "search-files")
    # one folder per (month, day): <base>/log/day=<yyyymm><dd>/; day = user hash, so folders are data-sized
    days = F.format_string("%02d", F.pmod(F.xxhash64("user_id"), F.lit(28)) + 1)
    month = F.when(F.col("period") == 1, F.lit("202206")).otherwise(F.lit("202207"))
    log = TD.search_log_tagged(spark, sf).select("user_id", "keyword", F.concat(month, days).alias("day"))
    write_parquet(log, f"{base}/log", partition_by=["day"], files_per_partition=1)
    tagged = search_plan.tagged_log(files.read_search_log(spark, f"{base}/log/day=202206*"),
                                    files.read_search_log(spark, f"{base}/log/day=202207*"))
    # the labelled top keywords of both months from one pass over the written log
    labelled = (Q.top_keyword(tagged).join(TD.keyword_mapping_tagged(spark, sf), ["period", "keyword"])
                .select("period", "user_id", "keyword", "search_count", "Genre"))
    labelled.write.partitionBy("period").option("header", True).csv(f"{base}/map")
    labels = [files.read_mapping(spark, f"{base}/map/period={p}").withColumn("period", F.lit(p)) for p in (1, 2)]
    return search_plan.search_change(tagged, labels[0].unionByName(labels[1]))


@query("content_from_json")
def content_from_json(spark, sf):
    """The whole log as JSON day folders nested under _source, profiled from the files."""
    base = scratch_path(spark, "content-json")
    flat = _flat(spark, sf)
    write_content_log(flat, base, layout="partitioned", files_per_day=FILES_PER_DAY)
    bounds = flat.agg(F.min("Process_Date").alias("lo"), F.max("Process_Date").alias("hi")).first()
    if bounds.lo is None:  # no events at all: the empty profile table
        return content_plan.content_table(spark.createDataFrame([], S.CONTENT_FLAT))
    scanned = files.content_range_scan(spark, base, bounds.lo, bounds.hi, layout="partitioned")
    return content_plan.content_table(scanned)


@query("content_profile_from_stream")
def content_profile_from_stream(spark, sf):
    """Day folders ingested by the file stream, then the period profile from the daily table."""
    src = scratch_path(spark, "stream-src")
    write_content_log(_flat(spark, sf), src, layout="partitioned", files_per_day=FILES_PER_DAY)
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    start_daily_profiles(spark, src, sink, ckpt, layout="partitioned", available_now=True,
                         files_per_day=FILES_PER_DAY).awaitTermination()
    return profile_from_daily(spark, sink)


# ── Commit steps and checks of writes ──────────────────────────────────────

@query("content_published")
def content_published(spark, sf):
    """The profile published, then a run that fails half-way and one that fails its check: the table is the first one's."""
    out = scratch_path(spark, "published")
    table = _content(spark, sf)
    publish(table, out)
    late = F.when(F.pmod(F.xxhash64("Contract"), F.lit(5)) == 0, F.raise_error(F.lit("lost half-way"))).otherwise(F.col("MostWatch"))
    for worse, check in ((table.withColumn("MostWatch", late), None), (table.limit(0), M.require_rows)):
        with contextlib.suppress(PySparkException, ValueError):
            publish(worse, out, check=check)
    return spark.read.parquet(out)


@query("rfm_appended_once")
def rfm_appended_once(spark, sf):
    """The result table appended in two runs, the second of them twice."""
    out, table = scratch_path(spark, "appended"), stored(rfm_plan.rfm_table(TD.transactions(spark, sf)), "rfm-table")
    for run, half in (("first", 0), ("second", 1), ("second", 1)):
        append_once(table.filter(F.col("CustomerID") % 2 == half), out, run)
    return read_runs(spark, out)


def _broken_log(spark, sf):
    """Published profile and quarantine of the log with some broken lines."""
    base, out, aside = (scratch_path(spark, f"lines-{name}") for name in ("log", "profile", "quarantine"))
    TD.content_log_lines(spark, sf).repartition(4).write.partitionBy("day").text(base)
    bounds = _flat(spark, sf).agg(F.min("Process_Date").alias("lo"), F.max("Process_Date").alias("hi")).first()
    days = [bounds.lo + dt.timedelta(days=i) for i in range((bounds.hi - bounds.lo).days + 1)]
    content_plan.publish_profile(spark, base, days, out, aside, max_share=0.1, layout="partitioned")
    return out, aside


@query("content_profile_quarantined")
def content_profile_quarantined(spark, sf):
    """The profile of a log with broken lines: that of its good lines."""
    return spark.read.parquet(_broken_log(spark, sf)[0])


@query("content_quarantine")
def content_quarantine(spark, sf):
    """The broken lines of that log."""
    return spark.read.parquet(_broken_log(spark, sf)[1]).select(iso("Process_Date"), "reason", "line")
