"""Sinks: Parquet / CSV / JSON files and JDBC tables, and result loaders.

Writes are distributed (one file per task, no ``coalesce(1)``). Re-runs
are idempotent with ``mode="overwrite"``; ``partition_by`` together with
dynamic partition overwrite replaces only the partitions a run produced.
Credentials are arguments, never literals.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cluster_for_write(df: DataFrame, partition_by: Sequence[str], files_per_partition: int | None) -> DataFrame:
    """Bound the number of files per output partition.

    Without clustering every task writes one file per partition value it
    holds (tasks x values files). Clustering on the partition columns alone
    would put a hot value (a day with a third of all rows) in one task; a
    deterministic hash salt spreads each value over ``files_per_partition``
    tasks instead, and a retried task writes the same rows.
    """
    if not partition_by or not files_per_partition:
        return df
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
    return df.repartition(*[F.col(c) for c in partition_by], salt)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                  files_per_partition: int | None = None) -> None:
    w = cluster_for_write(df, partition_by, files_per_partition).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              date_format: str = "yyyy-MM-dd") -> None:
    df.write.mode(mode).option("header", header).option("dateFormat", date_format).csv(path)


def write_content_log(flat: DataFrame, base: str, layout: str = "partitioned", mode: str = "overwrite",
                      files_per_day: int | None = None) -> None:
    """Flat viewing log -> JSON lines nested under ``_source``, one folder per day.

    ``partitioned``: one distributed write into ``<base>/day=<yyyyMMdd>/``.
    ``daily_files``: ``<base>/<yyyyMMdd>.json/`` folders (the reference's
    naming): the same write into a folder beside, whose day folders are then
    renamed (in append mode, their files moved).
    """
    nested = flat.select(F.struct("Contract", "Mac", "AppName", "TotalDuration").alias("_source"),
                         F.date_format("Process_Date", "yyyyMMdd").alias("day"))
    if layout not in ("partitioned", "daily_files"):
        raise ValueError("layout must be 'partitioned' or 'daily_files'")
    nested = cluster_for_write(nested, ["day"], files_per_day)
    if layout == "partitioned":
        nested.write.mode(mode).partitionBy("day").option("partitionOverwriteMode", "dynamic").json(base)
        return
    spark, base = flat.sparkSession, base.rstrip("/")
    beside = f"{base}/_writing-{uuid.uuid4().hex}"
    nested.write.partitionBy("day").json(beside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    for day in fs.listStatus(path(beside)):  # one folder per day
        name = day.getPath().getName()
        if not name.startswith("day="):
            continue
        target = path(f"{base}/{name[len('day='):]}.json")
        if mode == "append" and fs.exists(target):
            for f in fs.listStatus(day.getPath()):
                fs.rename(f.getPath(), target)
            continue
        fs.delete(target, True)
        fs.rename(day.getPath(), target)
    fs.delete(path(beside), True)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", user: str | None = None,
               password: str | None = None, driver: str | None = None, truncate: bool = True,
               batch_size: int = 10_000, num_partitions: int | None = None) -> None:
    """Append or overwrite a database table (``truncate`` keeps its DDL)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if user is not None:
        w = w.option("user", user)
    if password is not None:
        w = w.option("password", password)
    if driver is not None:
        w = w.option("driver", driver)
    if num_partitions is not None:
        w = w.option("numPartitions", num_partitions)
    if mode == "overwrite":
        w = w.option("truncate", str(truncate).lower())
    w.mode(mode).save()


def read_jdbc(spark: SparkSession, url: str, table: str, user: str | None = None, password: str | None = None,
              driver: str | None = None, partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Load a result table; a numeric ``partition_column`` splits the read."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def load_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A result table from a catalog name (``fmt="table"``) or a path."""
    if fmt == "table":
        return spark.table(source)
    return spark.read.format(fmt).load(source)
