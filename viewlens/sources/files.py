"""File sources with explicit schemas (no inference jobs, no drift).

Viewing logs are JSON lines, one folder or file per day, either
``<base>/<yyyyMMdd>.json`` (the reference layout) or ``<base>/day=<yyyyMMdd>/``
(what ``sinks.write_content_log`` produces). The base folder is listed once,
the wanted days that exist become one read, and each row's ``Process_Date``
comes from its file path -- one scan, not one union branch per day.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewlens import schemas as S
from viewlens.operators.content import flatten

# The last path segment "yyyyMMdd.json" or "day=yyyyMMdd" (the greedy prefix
# skips date-like folders higher up in the base path).
_DAY_IN_PATH = r"^.*/(?:day=)?(\d{8})(?:\.json)?(?:/|$)"


def _children(spark: SparkSession, base: str) -> list[str]:
    """Names in a folder, from one listing; raises when the folder does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"no such folder: {base}")
    return [f.getPath().getName() for f in fs.listStatus(path)]


def present_days(spark: SparkSession, base: str, layout: str = "daily_files") -> list[dt.date]:
    """The days that have a file or folder under ``base``, from one listing."""
    shape = {"daily_files": r"(\d{8})\.json", "partitioned": r"day=(\d{8})"}[layout]
    found = (re.fullmatch(shape, name) for name in _children(spark, base))
    return sorted(dt.datetime.strptime(m[1], "%Y%m%d").date() for m in found if m)


def day_paths(spark: SparkSession, base: str, days: Iterable[dt.date], layout: str = "daily_files") -> list[str]:
    """Paths of those of ``days`` that exist under ``base`` (one listing, whatever the number of days)."""
    shapes = {"daily_files": "{}.json", "partitioned": "day={}"}
    if layout not in shapes:
        raise ValueError("layout must be 'daily_files' or 'partitioned'")
    wanted = {shapes[layout].format(d.strftime("%Y%m%d")) for d in days}
    base = base.rstrip("/")
    return [f"{base}/{name}" for name in sorted(wanted.intersection(_children(spark, base)))]


def with_path_day(df: DataFrame, name: str) -> DataFrame:
    """Add the day of each row's file path as column ``name``."""
    return df.withColumn(name, F.to_date(F.regexp_extract(F.col("_metadata.file_path"), _DAY_IN_PATH, 1), "yyyyMMdd"))


def search_days(spark: SparkSession, base: str, days: Iterable[dt.date]) -> DataFrame:
    """(day, user_id, keyword) of the Parquet day folders ``<base>/day=<yyyyMMdd>/`` that exist; none at all raises."""
    days = list(days)
    paths = day_paths(spark, base, days, "partitioned")
    if not paths:
        raise FileNotFoundError(f"no day folder under {base}: {min(days)} to {max(days)}" if days else f"no day of {base}")
    log = with_path_day(spark.read.schema("user_id string, keyword string").parquet(*paths), "day")
    return log.select("day", "user_id", "keyword")


def read_content_json(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw viewing-log JSON with the fixed nested schema."""
    return spark.read.schema(S.CONTENT_LOG_JSON).json(paths)


def content_days(spark: SparkSession, base: str, days: Iterable[dt.date], layout: str = "daily_files") -> DataFrame:
    """Flat viewing log of the given days; missing days are skipped.

    A missing folder, or none of the days in it, raises: a mistyped path must
    not turn into an empty result that replaces a good one.
    """
    days = list(days)
    paths = day_paths(spark, base, days, layout)
    if not paths:
        span = f"{min(days)} to {max(days)}" if days else "no day"
        raise FileNotFoundError(f"no day file under {base} ({layout}): {span}")
    raw = with_path_day(read_content_json(spark, paths), "Process_Date")
    return flatten(raw).select(*[f.name for f in S.CONTENT_FLAT.fields])


def checked_content_days(spark: SparkSession, base: str, days: Iterable[dt.date], layout: str = "daily_files") -> DataFrame:
    """The lines of the given days, read as ``content_days`` reads them, with what is wrong with each.

    Flat columns, ``_file``, ``_line`` (the line's text) and ``_reason``: NULL for a good line, else ``does not parse`` (no JSON, or a
    value of another type) or ``no _source``. Blank lines are no lines.
    """
    days = list(days)
    paths = day_paths(spark, base, days, layout)
    if not paths:
        raise FileNotFoundError(f"no day file under {base} ({layout})")
    lines = with_path_day(spark.read.text(paths), "Process_Date").withColumn("_file", F.col("_metadata.file_path"))
    schema = T.StructType([*S.CONTENT_LOG_JSON.fields, T.StructField("_broken", T.StringType())])
    read = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    lines = lines.filter(F.trim("value") != "").withColumn("_read", read)
    reason = (F.when(F.col("_read").isNull() | F.col("_read._broken").isNotNull(), "does not parse")
              .when(F.col("_read._source").isNull(), "no _source"))
    return lines.select(*[F.col(f"_read._source.{f.name}").alias(f.name) if f.name != "Process_Date" else F.col("Process_Date")
                          for f in S.CONTENT_FLAT.fields], "_file", F.col("value").alias("_line"), reason.alias("_reason"))


def good_lines(lines: DataFrame) -> DataFrame:
    """The flat viewing log of the lines that are as they should be."""
    return lines.filter(F.col("_reason").isNull()).select(*[f.name for f in S.CONTENT_FLAT.fields])


def broken_lines(lines: DataFrame) -> DataFrame:
    """(Process_Date, file, reason, line) of the others."""
    return (lines.filter(F.col("_reason").isNotNull())
            .select("Process_Date", F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_line").alias("line")))


def content_range_scan(spark: SparkSession, base: str, start: dt.date, end: dt.date,
                       layout: str = "daily_files") -> DataFrame:
    """Flat viewing log of the inclusive day range; missing days are skipped (see ``content_days``)."""
    if end < start:
        raise ValueError(f"day range ends ({end}) before it starts ({start})")
    return content_days(spark, base, (start + dt.timedelta(days=i) for i in range((end - start).days + 1)), layout)


def read_search_log(spark: SparkSession, path: str, period: int | None = None,
                    period_col: str = "period") -> DataFrame:
    """Search log Parquet (glob allowed); only user_id and keyword are read.

    With ``period`` the partition column filter prunes folders of other
    periods before any file is opened.
    """
    df = spark.read.parquet(path)
    if period is not None:
        df = df.filter(F.col(period_col) == period)
    return df.select(F.col("user_id").cast("string"), F.col("keyword").cast("string"))


def _header_names(df: DataFrame) -> dict[str, str]:
    """Lower-cased header name (byte-order mark removed) -> column."""
    return {c.lower().lstrip("\ufeff").strip(): c for c in df.columns}


def _parsed(raw: Column, value: Column, what: str) -> Column:
    """``value``, or an error that names the text when a non-empty cell did not parse."""
    bad = raw.isNotNull() & (F.trim(raw) != "") & value.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"{what} does not parse: "), raw))).otherwise(value)


def read_transactions(spark: SparkSession, path: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Transactions from header CSV, columns by header name (case-insensitive), other columns ignored.

    Empty cells are NULL; a date, amount or customer id that does not parse
    raises when the row is read. Missing columns raise at once.
    """
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    names = _header_names(df)
    missing = [f.name for f in S.TRANSACTIONS.fields if f.name.lower() not in names]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}; present: {df.columns}")
    raw = {f.name: F.col(f"`{names[f.name.lower()]}`") for f in S.TRANSACTIONS.fields}
    text = {k: F.trim(c) for k, c in raw.items()}
    return df.select(
        raw["Transaction_ID"].alias("Transaction_ID"),
        _parsed(raw["CustomerID"], text["CustomerID"].try_cast("decimal(38,6)").try_cast("long"), "CustomerID").alias("CustomerID"),
        _parsed(raw["Purchase_Date"], F.try_to_timestamp(text["Purchase_Date"], F.lit(date_format)).cast("date"),
                f"Purchase_Date ({date_format})").alias("Purchase_Date"),
        _parsed(raw["GMV"], text["GMV"].try_cast("decimal(18,2)"), "GMV").alias("GMV"),
    )


def read_mapping(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Keyword labels -> (keyword, Genre).

    Columns are taken by header name (case-insensitive), so both the
    per-user labelled file (user_id, keyword, search_count, Genre) and a
    keyword dimension (keyword, Genre) are accepted, as CSV or Parquet.
    """
    if fmt == "csv":
        df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    names = _header_names(df)
    missing = [c for c in ("keyword", "genre") if c not in names]
    if missing:
        raise ValueError(f"{path}: mapping needs columns keyword and Genre, has {df.columns}")
    return df.select(F.col(f"`{names['keyword']}`").cast("string").alias("keyword"),
                     F.col(f"`{names['genre']}`").cast("string").alias("Genre"))


def read_most_search(spark: SparkSession, path: str) -> DataFrame:
    """Top-keyword CSV -> (user_id, keyword, search_count), columns by header name; a missing one raises."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    names = _header_names(df)
    missing = [f.name for f in S.MOST_SEARCH.fields if f.name.lower() not in names]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}; present: {df.columns}")
    return df.select(*[F.col(f"`{names[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in S.MOST_SEARCH.fields])


def read_result_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A stored result table (``rfm``, ``content`` or ``search``) from header CSV.

    Columns are matched by header name (case-insensitive) and cast to the
    result types, so no schema-inference pass runs and column order does not
    matter. Unknown columns are kept as strings.
    """
    types = S.RESULT_TYPES[table]
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    canon = {c.lower(): c for c in types}
    cols = []
    for c in df.columns:
        name = canon.get(c.lower().lstrip("\ufeff"))
        cols.append(F.col(f"`{c}`").cast(types[name]).alias(name) if name else F.col(f"`{c}`"))
    return df.select(*cols)
