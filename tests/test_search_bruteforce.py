"""The search change table against a brute-force Python implementation."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from viewlens.plans.search import search_change

KEYWORDS = ["a", "b", "c", "d", None]
GENRES = ["Drama", "News", "Other"]


def brute(log, mapping):
    counts = Counter((p, u, k) for p, u, k in log if k is not None)
    best = {}
    for (p, u, k), n in counts.items():
        cur = best.get((p, u))
        if cur is None or (-n, k) < (-cur[1], cur[0]):
            best[(p, u)] = (k, n)
    labelled = {(p, k) for p, k, _ in mapping}
    top = {(p, u): k for (p, u), (k, _) in best.items() if (p, k) in labelled}
    dim = {}
    for p, k, g in sorted(mapping, key=lambda r: (r[0], r[2])):
        dim.setdefault(k, g)
    out = set()
    for u in {u for _, u in top}:
        if (1, u) in top and (2, u) in top:
            k6, k7 = top[(1, u)], top[(2, u)]
            g6, g7 = dim.get(k6), dim.get(k7)
            ch = None if g6 is None or g7 is None else ("No Change" if g6 == g7 else f"{g6} -> {g7}")
            out.add((u, k6, g6, k7, g7, ch))
    return out


logs = st.lists(st.tuples(st.sampled_from([1, 2]), st.sampled_from(["u1", "u2", "u3", "u4"]),
                          st.sampled_from(KEYWORDS)), min_size=0, max_size=40)
maps = st.lists(st.tuples(st.sampled_from([1, 2]), st.sampled_from(KEYWORDS[:-1]), st.sampled_from(GENRES)),
                min_size=0, max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(log=logs, mapping=maps)
def test_search_change_equals_brute_force(spark, log, mapping):
    L = spark.createDataFrame(log, "period int, user_id string, keyword string")
    M = spark.createDataFrame(mapping, "period int, keyword string, Genre string")
    got = {tuple(r) for r in search_change(L, M).collect()}
    assert got == brute(log, mapping)
    got_salted = {tuple(r) for r in search_change(L, M, salt_buckets=3).collect()}
    assert got_salted == got
