"""Top keywords and keyword genres as catalog tables bucketed by keyword.

Tables that are joined again and again (new labels, other periods) are shuffled once, when they are saved: both sides have
the same buckets, sorted by keyword, so the genre join reads bucket against bucket without moving a row. A keyword is in one
bucket; for one that holds a large share of all users, ``search_change(..., salt_buckets=n)`` splits the join instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from viewlens import schemas as S
from viewlens.operators import search as Q

BUCKETS = 64


def save_bucketed(df: DataFrame, table: str, path: str | None = None, by: str = "keyword", buckets: int = BUCKETS) -> None:
    """Save ``df`` as a table of ``buckets`` files by hash of ``by``, each sorted. ``path``: its folder, else the warehouse's."""
    w = df.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(by)
    (w.option("path", path) if path else w).saveAsTable(table)


def save_search_tables(log: DataFrame, mapping: DataFrame, top_table: str, genre_table: str, folder: str | None = None, buckets: int = BUCKETS) -> None:
    """The two tables of the genre join: top keywords (period, user_id, keyword, search_count), genres (keyword, Genre, periods)."""
    save_bucketed(Q.top_keyword(log), top_table, f"{folder}/top" if folder else None, buckets=buckets)
    save_bucketed(Q.genre_dimension(mapping), genre_table, f"{folder}/genres" if folder else None, buckets=buckets)


def change_from_tables(spark: SparkSession, top_table: str, genre_table: str, labels: Sequence[str] = S.PERIOD_LABELS) -> DataFrame:
    """The change table from the saved tables."""
    return Q.change_of_top(spark.table(top_table), spark.table(genre_table), (1, 2), labels)
