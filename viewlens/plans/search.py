"""Search logs + keyword labels -> customer_search_stats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from viewlens import schemas as S
from viewlens.operators import search as Q


def tagged_log(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two (user_id, keyword) logs -> one tagged log."""
    return Q.tag(first, 1).unionByName(Q.tag(second, 2)).select("period", "user_id", "keyword")


def search_change(log: DataFrame, mapping: DataFrame, labels: Sequence[str] = S.PERIOD_LABELS,
                  salt_buckets: int = 0) -> DataFrame:
    """user_id, Most_Searched_T6, Genre_T6, Most_Searched_T7, Genre_T7, Changing."""
    return Q.change_table(log, mapping, (1, 2), labels, salt_buckets)


def search_change_stepwise(log: DataFrame, mapping: DataFrame,
                           labels: Sequence[str] = S.PERIOD_LABELS) -> DataFrame:
    """The same result built step by step (semi join, pivot, two genre joins)."""
    top = Q.top_keyword(log)
    pivot = Q.period_pivot(Q.mapped(top, mapping), (1, 2), labels)
    return Q.with_changing(Q.genre_enrich(pivot, Q.genre_dimension(mapping), labels), labels)
