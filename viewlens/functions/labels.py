"""Derived labels: most-watched category, taste, RFM code and segment,
search change label and status. Pure Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewlens import schemas as S


def category_of_app(app: Column, categories: Mapping[str, Sequence[str]] = S.APP_CATEGORIES) -> Column:
    """App code -> category label (NULL when unmapped), case-sensitive.

    A literal map lookup: no join, stays inside whole-stage codegen.
    """
    pairs = []
    for label, codes in categories.items():
        for code in codes:
            pairs += [F.lit(code), F.lit(label)]
    return F.create_map(*pairs)[app]


def most_watch(durations: Mapping[str, Column], priority: Sequence[str] = S.MOST_WATCH_PRIORITY) -> Column:
    """Category with the largest duration; ties resolved by ``priority``.

    With all durations zero the first priority category is returned.
    """
    top = F.greatest(*[durations[c] for c in priority])
    expr = None
    for c in priority:
        cond = durations[c] == top
        expr = F.when(cond, F.lit(c)) if expr is None else expr.when(cond, F.lit(c))
    return expr


def taste(durations: Mapping[str, Column], order: Sequence[str] = S.TASTE_ORDER) -> Column:
    """Categories with a positive duration joined by '-' ('' when none)."""
    return F.concat_ws("-", *[F.when(durations[c] > 0, F.lit(c)) for c in order])


def activity(active_days: Column, threshold: int = S.ACTIVE_DAYS_THRESHOLD) -> Column:
    return F.when(active_days > threshold, F.lit("High")).otherwise(F.lit("Low"))


def fm_score(f: Column, m: Column) -> Column:
    """The mean of both scores rounded half up, as int."""
    return F.round((f + m) / F.lit(2)).cast("int")


def rfm_code(r: Column, f: Column, m: Column) -> Column:
    return F.concat(r.cast("string"), f.cast("string"), m.cast("string"))


def segment(r: Column, fm: Column, rules=S.RFM_SEGMENT_RULES, default: str = S.RFM_DEFAULT_SEGMENT) -> Column:
    """First rule whose R and FM ranges both contain the scores, else default; a None bound is open."""
    expr = None
    for name, (rlo, rhi), (flo, fhi) in rules:
        cond = F.lit(True)
        for c, lo, hi in ((r, rlo, rhi), (fm, flo, fhi)):
            cond = cond if lo is None else cond & (c >= lo)
            cond = cond if hi is None else cond & (c <= hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))


def change_label(g1: Column, g2: Column) -> Column:
    """'No Change' when equal, 'G1 -> G2' otherwise; NULL if either is NULL."""
    return F.when(g1 == g2, F.lit(S.NO_CHANGE)).otherwise(F.concat(g1, F.lit(S.CHANGE_ARROW), g2))


def change_status(changing: Column, unchanged: str = "Unchanged", changed: str = "Changed") -> Column:
    """Two-way status; a NULL label counts as changed (as a Python ``==``)."""
    return F.when(changing.eqNullSafe(S.NO_CHANGE), F.lit(unchanged)).otherwise(F.lit(changed))
