"""Commit steps for result tables: write beside, check, swap; runs that add their rows once.

A plain overwrite deletes the old table before the job that makes the new one has run. ``publish`` writes the new table
into a folder beside, checks it, and only then puts it in the old one's place by renames; a job that fails, or whose result
fails the check, leaves the old table as it was. A driver that dies between the two renames is made good by the next
``publish`` or by ``recover``.

``append_once`` keeps every run's rows in a folder of the run's id, so a run that is repeated replaces its own rows.
``publish_jdbc`` loads a database table through a table beside it: the tasks fill that one, and a single transaction moves
its rows, with a ledger of run ids that makes a repeated append add nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run_id"
LEDGER = "viewlens_runs"
_RUN_ID = re.compile(r"[A-Za-z0-9_.-]+")


def _run_id(run_id: str | None) -> str:
    if run_id is None:
        return uuid.uuid4().hex
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"a run id consists of letters, digits and _ . - only: {run_id!r}")
    return run_id


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _beside(path: str, what: str) -> str:
    """A hidden neighbour of ``path``: readers of the parent folder skip it."""
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}_{name}.{what}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; one that does not exist is no error."""
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish what an interrupted swap left: the old table comes back if no new one took its place, else it goes."""
    old = _beside(path, "old")
    if exists(spark, old):
        fs, at = _fs(spark, path)
        if fs.exists(at):
            fs.delete(_fs(spark, old)[1], True)
        else:
            fs.rename(_fs(spark, old)[1], at)


def _swap(spark: SparkSession, new: str, path: str) -> None:
    fs, at = _fs(spark, path)
    old = _fs(spark, _beside(path, "old"))[1]
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"{path} cannot be moved aside")
    if not fs.rename(_fs(spark, new)[1], at):
        if had:
            fs.rename(old, at)
        raise OSError(f"{new} cannot take the place of {path}")
    if had:
        fs.delete(old, True)


def publish(df: DataFrame, path: str, fmt: str = "parquet", check: Callable[[DataFrame], None] | None = None,
            options: dict | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the table at ``path`` by ``df``, or leave it as it was.

    ``df`` may read the table that it replaces. ``check`` gets the written table, read back with the schema of ``df``, and
    raises to refuse it. One writer at a time.
    """
    spark = df.sparkSession
    recover(spark, path)
    new = _beside(path, f"new-{uuid.uuid4().hex}")
    fs, at = _fs(spark, new)
    try:
        writer = df.write.format(fmt).options(**(options or {}))
        (writer.partitionBy(*partition_by) if partition_by else writer).save(new)
        if check is not None:
            check(spark.read.format(fmt).options(**(options or {})).schema(df.schema).load(new))
        _swap(spark, new, path)
    finally:
        fs.delete(at, True)  # nothing is there after a swap


def append_once(df: DataFrame, path: str, run_id: str) -> None:
    """Add a run's rows to a Parquet table; the same run again replaces them. The rows of other runs stay."""
    if RUN in df.columns:
        raise ValueError(f"the rows have a column {RUN} of their own")
    (df.withColumn(RUN, F.lit(_run_id(run_id))).write.mode("overwrite").partitionBy(RUN)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all runs of ``append_once``."""
    return spark.read.parquet(path).drop(RUN)


def _connection(spark: SparkSession, url: str, user: str | None, password: str | None, driver: str | None):
    jvm = spark._jvm
    if driver is not None:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
    properties = jvm.java.util.Properties()
    for key, value in (("user", user), ("password", password)):
        if value is not None:
            properties.setProperty(key, value)
    return jvm.java.sql.DriverManager.getConnection(url, properties)


def _has_table(connection, table: str) -> bool:
    statement = connection.createStatement()
    try:
        statement.executeQuery(f"SELECT 1 FROM {table} WHERE 1 = 0").close()
        return True
    except Exception:  # noqa: BLE001 - databases name a missing table in many ways
        return False
    finally:
        statement.close()


def _run_in(connection, *statements: str) -> None:
    for sql in statements:
        statement = connection.createStatement()
        statement.executeUpdate(sql)
        statement.close()


def publish_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", run_id: str | None = None, user: str | None = None,
                 password: str | None = None, driver: str | None = None, batch_size: int = 10_000,
                 num_partitions: int | None = None) -> bool:
    """Load a database table in one transaction; whether rows were added.

    The tasks write ``<table>_beside_<...>``; then its rows replace the table's (``overwrite``) or are added to them
    (``append``). The run id and the table's name go into the ledger table in the same transaction, and a run that is in the
    ledger adds nothing when it is repeated. A failing job leaves the table as it was.
    """
    from viewlens.sources.sinks import write_jdbc

    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be 'append' or 'overwrite'")
    spark, run = df.sparkSession, _run_id(run_id)
    access = {"user": user, "password": password, "driver": driver}
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    connection = _connection(spark, url, **access)
    beside = f"{table}_beside_{uuid.uuid4().hex[:12]}"
    known = f"FROM {LEDGER} WHERE run = '{run}' AND loaded = '{table}'"
    try:
        if not _has_table(connection, LEDGER):
            _run_in(connection, f"CREATE TABLE {LEDGER} (run VARCHAR(128) NOT NULL, loaded VARCHAR(128) NOT NULL, PRIMARY KEY (run, loaded))")
        if mode == "append" and _count(connection, known):
            return False
        write_jdbc(df, url, beside, "overwrite", batch_size=batch_size, num_partitions=num_partitions, **access)
        if not _has_table(connection, table):
            write_jdbc(df.limit(0), url, table, "append", **access)
        columns = ", ".join(quote(c) for c in df.columns)
        connection.setAutoCommit(False)
        try:
            _run_in(connection, *([f"DELETE FROM {table}"] if mode == "overwrite" else []), f"DELETE {known}",
                    f"INSERT INTO {LEDGER} VALUES ('{run}', '{table}')",
                    f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {beside}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.setAutoCommit(True)
        return True
    finally:
        if _has_table(connection, beside):
            _run_in(connection, f"DROP TABLE {beside}")
        connection.close()


def _count(connection, known: str) -> int:
    statement = connection.createStatement()
    rows = statement.executeQuery(f"SELECT count(*) {known}")
    rows.next()
    n = rows.getInt(1)
    rows.close()
    statement.close()
    return n
