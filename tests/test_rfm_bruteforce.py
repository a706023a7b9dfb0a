"""The RFM table against a brute-force Python implementation."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from viewlens import schemas as S
from viewlens.plans.rfm import rfm_table


def ntile(keys, n):
    """keys: list of (sort_key, id) -> {id: tile} with standard tile sizes."""
    order = sorted(keys)
    q, r = divmod(len(order), n)
    out, i = {}, 0
    for t in range(1, n + 1):
        size = q + (1 if t <= r else 0)
        for _ in range(size):
            out[order[i][1]] = t
            i += 1
    return out


def segment(r, fm):
    for name, (rlo, rhi), (flo, fhi) in S.RFM_SEGMENT_RULES:
        if all((lo is None or x >= lo) and (hi is None or x <= hi) for x, lo, hi in ((r, rlo, rhi), (fm, flo, fhi))):
            return name
    return S.RFM_DEFAULT_SEGMENT


def brute(rows, n=5):
    ok = [x for x in rows if x[3] is not None and x[3] > 0 and x[1] is not None and x[1] != 0]
    if not ok:
        return set()
    cust = {}
    for tid, c, day, gmv in ok:
        last, freq, mon = cust.get(c, (None, 0, Decimal(0)))
        cust[c] = (day if last is None or day > last else last, freq + 1, mon + gmv)
    ref = max(v[0] for v in cust.values()) + dt.timedelta(days=1)
    rec = {c: (ref - v[0]).days for c, v in cust.items()}
    r_t = ntile([(rec[c], c) for c in cust], n)
    f_t = ntile([(v[1], c) for c, v in cust.items()], n)
    m_t = ntile([(v[2], c) for c, v in cust.items()], n)
    out = set()
    for c, (last, freq, mon) in cust.items():
        cents = int(mon * 100)
        aov = float((2 * cents + 100 * freq) // (200 * freq))
        R, F, M = n + 1 - r_t[c], f_t[c], m_t[c]
        fm = (F + M + 1) // 2
        out.add((c, rec[c], freq, float(mon), aov, f"{R}{F}{M}", segment(R, fm)))
    return out


rows = st.lists(st.tuples(st.integers(0, 10**6).map(str), st.sampled_from([0, 1, 2, 3, 4, 5, 6, 7, None]),
                          st.integers(1, 40).map(lambda d: dt.date(2024, 1, 1) + dt.timedelta(days=d)),
                          st.one_of(st.none(), st.integers(-500, 5000).map(lambda x: Decimal(x) / 100))),
                min_size=0, max_size=50)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_rfm_table_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, S.TRANSACTIONS)
    got = {tuple(r) for r in rfm_table(df).collect()}
    assert got == brute(data)
