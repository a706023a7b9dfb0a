"""The content profile against a brute-force Python implementation."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from viewlens import schemas as S
from viewlens.plans.content import content_table

APP_TO_CAT = {code: cat for cat, codes in S.APP_CATEGORIES.items() for code in codes}


def labels(d):
    top = max(d.values())
    most = next(c for c in S.MOST_WATCH_PRIORITY if d[c] == top)
    taste = "-".join(c for c in S.TASTE_ORDER if d[c] > 0)
    return most, taste


def brute(rows):
    daily = defaultdict(lambda: {"macs": set(), "dur": {c: 0 for c in S.TASTE_ORDER}})
    for contract, mac, app, dur, day in rows:
        cat = APP_TO_CAT.get(app)
        if cat is None or contract is None or contract == "0":
            continue
        d = daily[(contract, day)]
        if mac is not None:
            d["macs"].add(mac)
        d["dur"][cat] += dur
    per = defaultdict(list)
    for (contract, day), d in daily.items():
        per[contract].append((day, d))
    out = set()
    for contract, days in per.items():
        days.sort(key=lambda x: x[0])
        totals = {c: sum(d["dur"][c] for _, d in days) for c in S.TASTE_ORDER}
        most, taste = labels(days[0][1]["dur"])
        active = "High" if len(days) > S.ACTIVE_DAYS_THRESHOLD else "Low"
        out.add((contract, sum(len(d["macs"]) for _, d in days),
                 *[totals[c] for c in S.TASTE_ORDER], most, taste, active))
    return out


rows = st.lists(st.tuples(st.sampled_from(["0", "A", "B", "C", None]), st.sampled_from(["m1", "m2", None]),
                          st.sampled_from(["KPLUS", "VOD", "RELAX", "CHILD", "SPORT", "kplus", "X", None]),
                          st.integers(0, 5), st.integers(1, 6).map(lambda d: dt.date(2024, 1, d))),
                min_size=0, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_content_profile_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, S.CONTENT_FLAT)
    got = {tuple(r) for r in content_table(df).collect()}
    assert got == brute(data)
