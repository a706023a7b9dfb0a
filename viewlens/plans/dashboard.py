"""All dashboard marts from the three stored result tables.

Loaded tables are first normalised (canonical headers, trimmed strings),
checked for the columns each group needs, then filtered the way the
dashboard's widgets filter them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from viewlens import schemas as S
from viewlens.operators import mart_sets as G
from viewlens.operators import marts as M
from viewlens.operators.search import normalize
from viewlens.session import stored


def dashboard_marts(rfm: DataFrame | None = None, content: DataFrame | None = None,
                    search: DataFrame | None = None, segments: Sequence[str] | None = None,
                    most_watch: Sequence[str] | None = None, active: Sequence[str] | None = None,
                    genres_t6: Sequence[str] | None = None, genres_t7: Sequence[str] | None = None,
                    change: str = "all") -> dict[str, DataFrame]:
    """name -> mart DataFrame for every table given.

    Each table is read once, by one aggregate over all grouping sets of its marts; its rows, a few per key, are stored and the
    marts read them. (The filter options, over the unfiltered tables, are a lazy scan of their own.)
    """
    out: dict[str, DataFrame] = {}
    if rfm is not None:
        r = M.rfm_filtered(M.require_columns(normalize(rfm, S.RFM_COLUMNS), S.RFM_COLUMNS, "customer_rfm_stats"),
                           segments)
        out.update(G.rfm_marts(stored(G.rfm_sets(r), "rfm-sets")))
    if content is not None:
        c = M.content_filtered(M.require_columns(normalize(content, S.CONTENT_PROFILE_COLUMNS),
                                                 S.CONTENT_PROFILE_COLUMNS, "customer_content_stats"),
                               most_watch, active)
        out.update(G.content_marts(stored(G.content_sets(c), "content-sets")))
    if search is not None:
        needed = [c for c in S.SEARCH_CHANGE_COLUMNS if c != "Changing"]  # the other marts do without it
        s = M.search_filtered(M.require_columns(normalize(search), needed, "customer_search_stats"),
                              genres_t6, genres_t7, change)
        out.update(G.search_marts(stored(G.search_sets(s), "search-sets")))
    if rfm is not None and content is not None and search is not None:
        out["filter_options"] = M.filter_options(normalize(rfm, S.RFM_COLUMNS),
                                                 normalize(content, S.CONTENT_PROFILE_COLUMNS), normalize(search))
    return out
