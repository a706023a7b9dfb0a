"""Command line jobs, one per reference script.

    python -m viewlens.cli content --source DIR --start 20220401 --end 20220430 --out PATH
    python -m viewlens.cli top-keywords --first 'log_search/202206*' --second 'log_search/202207*' --out DIR
    python -m viewlens.cli classify --input DIR_OF_TOP_KEYWORDS --out DIR
    python -m viewlens.cli search --first GLOB --second GLOB --mapping-first CSV --mapping-second CSV --out PATH
    python -m viewlens.cli rfm --transactions CSV --out PATH
    python -m viewlens.cli marts --rfm PATH --content PATH --search PATH --out DIR
    python -m viewlens.cli stream-content --source DIR --sink PATH --checkpoint PATH
    python -m viewlens.cli refresh-content --source DIR --sink PATH --ledger PATH
    python -m viewlens.cli devices --source DIR --start 20220401 --end 20220430 --state DIR --out PATH
    python -m viewlens.cli search-days --source DIR --checkpoint DIR --state DIR --first 20220601 20220630 --second 20220701 20220731 --out PATH

Results go to Parquet (default), CSV, or a JDBC table (``--jdbc-url``,
``--table``, ``--user``; the password is read from the environment
variable named by ``--password-env``). The caller's Spark configuration
(spark-submit) is used as is.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CSV_OPTIONS = {"header": "true", "dateFormat": "yyyy-MM-dd"}


def _date(s: str) -> dt.date:
    return dt.datetime.strptime(s, "%Y%m%d").date()


def _jdbc_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--jdbc-url")
    p.add_argument("--user")
    p.add_argument("--password-env")
    p.add_argument("--driver")


def _sink_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--out", help="output path (Parquet or CSV)")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "jdbc"])
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--run-id", help="names an appending run: repeated, it adds its rows once (Parquet and JDBC)")
    p.add_argument("--table")
    _jdbc_args(p)


def _password(a: argparse.Namespace) -> str | None:
    return os.environ.get(a.password_env) if a.password_env else None


def _write(df: DataFrame, a: argparse.Namespace, sub_dir: str = "") -> None:
    from viewlens.sources import sinks
    from viewlens.sources.publish import append_once, publish, publish_jdbc
    if a.format == "jdbc":
        publish_jdbc(df, a.jdbc_url, a.table, a.mode, a.run_id, a.user, _password(a), a.driver)
        return
    path = f"{a.out.rstrip('/')}/{sub_dir}" if sub_dir else a.out
    if a.mode == "overwrite":  # beside first, so a failing run leaves the old table
        publish(df, path, a.format, options=CSV_OPTIONS if a.format == "csv" else None)
    elif a.run_id and a.format == "parquet":
        append_once(df, path, a.run_id)
    else:
        (sinks.write_csv if a.format == "csv" else sinks.write_parquet)(df, path, a.mode)


def _print_rows(df: DataFrame) -> None:
    """A small summary as JSON lines."""
    for row in df.collect():
        print(json.dumps(row.asDict(), ensure_ascii=False, default=str))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="viewlens")
    sub = ap.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("content")
    c.add_argument("--source", required=True)
    c.add_argument("--start", required=True, type=_date)
    c.add_argument("--end", required=True, type=_date)
    c.add_argument("--layout", default="daily_files", choices=["daily_files", "partitioned"])
    c.add_argument("--labels", default="first_day", choices=["first_day", "period"])
    c.add_argument("--from-daily", action="store_true",
                   help="--source is the stream-content daily table (Parquet), not JSON day files")
    c.add_argument("--quarantine", help="Parquet folder for the log's broken lines; the profile (--out, overwritten) is of the good ones")
    c.add_argument("--max-broken-share", type=float, default=0.01, help="with --quarantine: more broken lines than this share fail the run")
    _sink_args(c)

    t = sub.add_parser("top-keywords")
    t.add_argument("--first", required=True)
    t.add_argument("--second", required=True)
    t.add_argument("--report", type=int, metavar="K",
                   help="print the number of distinct keywords and each month's K most frequent as JSON lines")
    _sink_args(t)

    k = sub.add_parser("classify")
    k.add_argument("--input", required=True, help="top-keyword folder (user_id, keyword, search_count)")
    k.add_argument("--input-format", default="csv", choices=["csv", "parquet"])
    k.add_argument("--overrides", help="optional CSV (keyword, Genre) that wins over the rules")
    k.add_argument("--labeller", help="module:function taking a list of keywords, returning labels "
                                      "(e.g. a model client); runs on executors in batches")
    k.add_argument("--batch-size", type=int, default=100)
    k.add_argument("--ledger", help="Parquet folder of the labeller's answers, written batch by batch: a run that died is resumed")
    k.add_argument("--partitions", type=int, help="tasks that call the labeller (default: the cluster's parallelism)")
    k.add_argument("--names", help="optional CSV (keyword, Genre) of countries, clubs and events for the rules")
    k.add_argument("--known", help="existing (keyword, Genre) labels; only new keywords are labelled "
                                   "(write the result to a different --out than --known)")
    _sink_args(k)

    s = sub.add_parser("search")
    s.add_argument("--first", required=True)
    s.add_argument("--second", required=True)
    s.add_argument("--mapping-first", required=True)
    s.add_argument("--mapping-second", required=True)
    s.add_argument("--mapping-format", default="csv", choices=["csv", "parquet", "json"])
    s.add_argument("--salt-buckets", type=int, default=0, help="split a hot keyword of the genre join into so many parts")
    _sink_args(s)

    r = sub.add_parser("rfm")
    r.add_argument("--transactions", required=True)
    r.add_argument("--date-format", default="yyyy-MM-dd")
    r.add_argument("--as-of", type=_date)
    r.add_argument("--audit", action="store_true",
                   help="print cleaning counts and customers per segment as JSON lines")
    _sink_args(r)

    mk = sub.add_parser("marts", help="dashboard marts from stored result tables")
    mk.add_argument("--rfm", help="customer_rfm_stats (path or table)")
    mk.add_argument("--content", help="customer_content_stats (path or table)")
    mk.add_argument("--search", help="customer_search_stats (path or table)")
    mk.add_argument("--input-format", default="parquet", help="parquet, csv, json, table, or jdbc (then the three name tables)")
    _jdbc_args(mk)
    mk.add_argument("--split-rfm", metavar="COLUMN", help="jdbc: read the RFM table in parts of this numeric column, for example CustomerID")
    mk.add_argument("--split-from", type=int, default=0)
    mk.add_argument("--split-to", type=int, default=1_000_000)
    mk.add_argument("--split-tasks", type=int, default=8)
    mk.add_argument("--segments", nargs="*")
    mk.add_argument("--most-watch", nargs="*")
    mk.add_argument("--active", nargs="*")
    mk.add_argument("--genre-t6", nargs="*")
    mk.add_argument("--genre-t7", nargs="*")
    mk.add_argument("--change", default="all", choices=["all", "unchanged", "changed"])
    mk.add_argument("--out", required=True, help="folder; one Parquet table per mart")

    dv = sub.add_parser("devices", help="distinct devices of any days from stored bitmaps")
    dv.add_argument("--state", required=True, help="folder of the stored bitmaps")
    dv.add_argument("--source", help="viewing log whose days --start to --end are added to the state first")
    dv.add_argument("--layout", default="daily_files", choices=["daily_files", "partitioned"])
    dv.add_argument("--start", type=_date, help="first day, added and reported")
    dv.add_argument("--end", type=_date, help="last day")
    _sink_args(dv)

    sd = sub.add_parser("search-days", help="top keywords of two months from stored day counts")
    sd.add_argument("--state", required=True, help="folder of the stored counts")
    sd.add_argument("--source", help="Parquet day folders (day=yyyyMMdd) to add; needs --checkpoint")
    sd.add_argument("--checkpoint", help="folder that remembers which files were added")
    sd.add_argument("--first", nargs=2, type=_date, metavar=("START", "END"))
    sd.add_argument("--second", nargs=2, type=_date, metavar=("START", "END"))
    _sink_args(sd)

    rf = sub.add_parser("refresh-content", help="bring the daily profiles up to date: reads new and changed day files only")
    rf.add_argument("--source", required=True)
    rf.add_argument("--sink", required=True)
    rf.add_argument("--ledger", required=True)
    rf.add_argument("--layout", default="daily_files", choices=["daily_files", "partitioned"])

    st = sub.add_parser("stream-content")
    st.add_argument("--source", required=True)
    st.add_argument("--sink", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--layout", default="daily_files", choices=["daily_files", "partitioned"])
    st.add_argument("--devices", help="folder that also keeps the days' distinct devices as bitmaps")
    st.add_argument("--continuous", action="store_true", help="keep running (default: process what exists)")

    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"viewlens-{a.cmd}").getOrCreate()

    from viewlens.operators import classify as K
    from viewlens.operators import search as Q
    from viewlens.plans.content import content_table, publish_profile
    from viewlens.plans.rfm import rfm_table, rfm_table_audited
    from viewlens.plans.search import search_change, tagged_log
    from viewlens.sources import files

    if a.cmd == "content":
        if a.quarantine:
            if a.format == "jdbc" or a.mode == "append" or a.from_daily:
                ap.error("content: --quarantine goes with JSON day files and an overwritten --out")
            days = [a.start + dt.timedelta(days=i) for i in range((a.end - a.start).days + 1)]
            print(json.dumps(publish_profile(spark, a.source, days, a.out, a.quarantine, a.max_broken_share, a.layout, a.labels, fmt=a.format,
                                             options=CSV_OPTIONS if a.format == "csv" else None)))
        elif a.from_daily:
            from viewlens.streaming.content_daily import profile_from_daily
            _write(profile_from_daily(spark, a.source, a.start, a.end, a.labels), a)
        else:
            flat = files.content_range_scan(spark, a.source, a.start, a.end, a.layout)
            _write(content_table(flat, a.labels), a)
    elif a.cmd == "top-keywords":
        # One pass over both months; one output folder per month, each
        # (user_id, keyword, search_count) as the labelling step reads it.
        log = tagged_log(files.read_search_log(spark, a.first), files.read_search_log(spark, a.second))
        # A database gets one table with a period column.
        if a.format != "jdbc" and not a.out:
            ap.error("top-keywords: --out is required for files")
        top = Q.top_keyword(log)
        if a.format == "jdbc":
            _write(top.select("period", "user_id", "keyword", "search_count"), a)
        else:
            for p, sub_dir in ((1, "first"), (2, "second")):
                _write(top.filter(F.col("period") == p).select("user_id", "keyword", "search_count"), a, sub_dir)
        if a.report:
            _print_rows(Q.distinct_keywords(log))
            _print_rows(Q.keyword_popularity(top, a.report).orderBy("period", F.desc("count"), "keyword"))  # 2 K rows at most
    elif a.cmd == "classify":
        kw = (files.read_most_search(spark, a.input) if a.input_format == "csv"
              else spark.read.parquet(a.input).select("keyword"))
        labeller = None
        if a.labeller:
            import importlib

            from pyspark import cloudpickle
            mod_name, _, fn = a.labeller.partition(":")
            module = importlib.import_module(mod_name)
            # Ship the labeller's code with the tasks: executors need not
            # have the module installed.
            cloudpickle.register_pickle_by_value(module)
            labeller = getattr(module, fn)
        ov = files.read_mapping(spark, a.overrides) if a.overrides else None
        names = files.read_mapping(spark, a.names).withColumnRenamed("keyword", "name") if a.names else None
        failures = spark.sparkContext.accumulator(0)
        if a.known:
            labels = K.classify_incremental(kw, files.read_mapping(spark, a.known), labeller, a.batch_size, a.partitions, ov,
                                            names, failures)
        elif labeller and a.ledger:
            labels = K.with_overrides(K.classify_resumable(kw, labeller, a.ledger, a.batch_size), ov)
        elif labeller:
            labels = K.with_overrides(K.classify_batched(kw, labeller, a.batch_size, a.partitions, failures=failures), ov)
        else:
            labels = K.classify_rules(kw, ov, names)
        _write(labels, a)
        if labeller:
            print(json.dumps({"failed_keywords": failures.value}))
    elif a.cmd == "search":
        log = tagged_log(files.read_search_log(spark, a.first), files.read_search_log(spark, a.second))
        m = (files.read_mapping(spark, a.mapping_first, a.mapping_format).withColumn("period", F.lit(1))
             .unionByName(files.read_mapping(spark, a.mapping_second, a.mapping_format).withColumn("period", F.lit(2))))
        _write(search_change(log, m, salt_buckets=a.salt_buckets), a)
    elif a.cmd == "rfm":
        tx = files.read_transactions(spark, a.transactions, a.date_format)
        if a.audit:
            from viewlens.operators import rfm as R
            table, audit = rfm_table_audited(tx, a.as_of)  # the run counts its own rows
            _write(table, a)
            print(json.dumps(audit))
            _print_rows(R.segment_counts(table))  # one row per segment
        else:
            _write(rfm_table(tx, a.as_of), a)
    elif a.cmd == "marts":
        from viewlens.plans.dashboard import dashboard_marts
        from viewlens.sources.sinks import load_table, read_jdbc, write_parquet

        def load(src, table):
            """The table; one aggregate reads it for all of its marts."""
            if src is None:
                return None
            if a.input_format == "csv":
                df = files.read_result_csv(spark, src, table)
            elif a.input_format == "jdbc":
                split = dict(partition_column=a.split_rfm, lower=a.split_from, upper=a.split_to, num_partitions=a.split_tasks) if (
                    table == "rfm" and a.split_rfm) else {}
                df = read_jdbc(spark, a.jdbc_url, src, a.user, _password(a), a.driver, **split)
            else:
                df = load_table(spark, src, a.input_format)
            return df

        marts = dashboard_marts(load(a.rfm, "rfm"), load(a.content, "content"), load(a.search, "search"),
                                segments=a.segments,
                                most_watch=a.most_watch, active=a.active, genres_t6=a.genre_t6,
                                genres_t7=a.genre_t7, change=a.change)
        for name, df in marts.items():
            write_parquet(df, f"{a.out.rstrip('/')}/{name}")
    elif a.cmd == "devices":
        from viewlens.operators.content import valid_views
        from viewlens.plans import devices
        if a.source:
            if not (a.start and a.end):
                ap.error("devices: --source needs --start and --end")
            devices.add_days(valid_views(files.content_range_scan(spark, a.source, a.start, a.end, a.layout)), a.state)
        if a.out or a.table:
            _write(devices.distinct_devices(spark, a.state, a.start, a.end), a)
    elif a.cmd == "search-days":
        from viewlens.plans import search_state
        from viewlens.streaming.search_daily import start_daily_counts
        if a.source:
            if not a.checkpoint:
                ap.error("search-days: --source needs --checkpoint")
            start_daily_counts(spark, a.source, a.state, a.checkpoint).awaitTermination()
        if a.out or a.table:
            periods = {p: tuple(days) for p, days in ((1, a.first), (2, a.second)) if days}
            if not periods:
                ap.error("search-days: a result needs --first or --second")
            _write(search_state.top_keyword(spark, a.state, periods), a)
    elif a.cmd == "refresh-content":
        from viewlens.plans.refresh import refresh_daily
        print(json.dumps({"rebuilt": [str(d) for d in refresh_daily(spark, a.source, a.sink, a.ledger, a.layout)]}))
    elif a.cmd == "stream-content":
        from viewlens.streaming.content_daily import start_daily_profiles
        q = start_daily_profiles(spark, a.source, a.sink, a.checkpoint, a.layout, available_now=not a.continuous, devices=a.devices)
        q.awaitTermination()


if __name__ == "__main__":
    main()
