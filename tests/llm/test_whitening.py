import math

import numpy as np
import pytest
from frames import CLASHING, SF
from pyspark.sql import functions as F
from viewlens.llm import whitening
from viewlens.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k=8):
    """Whitening of the usable rows by numpy, exact where the contract asks for it."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    y = np.array([[(n * r[j] - s[j]) / n for j in range(d)] for r in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, dev, y, e, u, np.trace(y.T @ y / n)


def check(out, rows, k=8):
    n, dev, y, e, u, trace = plain(rows, k)
    by = {}
    for r in out:
        by.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(by) == list(range(1, min(k, len(rows[0][1])) + 1))
    for c, got in by.items():
        z = y @ u[:, c - 1] / math.sqrt(e[c - 1])
        mine = np.array([got[i].whitened for i, _ in rows])
        sign = np.sign(mine @ z)
        assert np.allclose(mine, sign * z, atol=1e-7), c
        assert [got[i].deviation for i, _ in rows] == dev
        assert all(g.n == n and g.explained == pytest.approx(e[c - 1] / trace, rel=1e-6) and g.identity_error < 1e-8 for g in got.values())


def test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    out = QUERIES["op12_block_whitening"](spark, SF).collect()
    assert len(out) == 8 * len(rows)
    check(out, rows)


def test_many_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 64)
    monkeypatch.setattr(whitening, "TASK_ENTRIES", 256)
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=5) * [5, 4, 3, 2, 1] + 7).tolist()) for i in range(403)]
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect(), rows)


def test_edges(spark):
    rng = np.random.default_rng(8)
    good = [(i, rng.normal(size=3).tolist()) for i in range(20)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 0.0, 0.0]), (104, [1.0, 2.0]), (105, [float("-inf"), 0.0, 0.0])]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHING})
    check(whitening.whiten(df).collect(), good)
    assert whitening.whiten(df.limit(0)).count() == 0
    twice = whitening.whiten(df.unionByName(df).withColumn("vec_id", F.lit(None).cast("long"))).collect()
    assert len(twice) == 2 * 20 * 3 and {r.vec_id for r in twice} == {None} and {r.n for r in twice} == {40}


def test_no_variance(spark):
    rows = [(i, [float(i % 2), 3.0, -1.0]) for i in range(6)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    first = [r for r in out if r.component == 1]
    assert all(abs(abs(r.whitened) - 1) < 1e-9 and r.explained == pytest.approx(1) for r in first)
    assert all(r.whitened is None and r.explained == 0 for r in out if r.component > 1)
    one = whitening.whiten(spark.createDataFrame(rows[:1], SCHEMA)).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in one] == [(None, 0.0, 0, None)] * 3


def test_large_entries(spark):
    rows = [(0, [2.0**22, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 5.0])]  # squares beyond a long are added as decimals
    n, dev, *_ = plain(rows)
    if max(dev) < 2**63:
        check(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows)
    with pytest.raises(Exception, match="fit a long"):
        whitening.whiten(spark.createDataFrame([(0, [2.0**40]), (1, [0.0])], SCHEMA)).collect()
