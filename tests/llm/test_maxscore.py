import math
import random

import numpy as np
import pytest
from frames import CLASHING, SF
from pyspark.sql import functions as F
from viewlens.checks.compare import compare_one, duck
from viewlens.llm import maxscore
from viewlens.llm.queries import QUERIES, SQL

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k=5, every=50):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q in {i for i, _ in usable if i is not None and i % every == 0}:
        best = {}
        for own, v in usable:
            if own == q:
                for i, w in usable:
                    if i != q:
                        best[i] = max(best.get(i, -10**30), sum(a * b for a, b in zip(v, w, strict=False)))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]
        out |= {(q, r, i, s) for r, (i, s) in enumerate(top, 1)}
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHING})
    got = [tuple(r) for r in maxscore.top(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_sql(spark):
    r = compare_one(spark, duck(SF), "op11", QUERIES["op11_maxscore_top"], SQL["op11_maxscore_top"], SF)
    assert r["ok"], r


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force_over_many_shards(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(300):
        v = [round(c + rng.gauss(0, 0.3), 2) for c in rng.choice(centres)]
        rows.append((i * 5, v[:rng.choice([6, 6, 3, 0])]))
    rows += [(i, [0.5] * 6) for i in range(2000, 2100)]  # one very common vector: ties by id
    assert found(spark, rows, shard=(64, 64), block=(32, 32)) == plain(rows)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-3.0, 0.1]), (50, None), (100, []), (1, [1.0, None]), (2, [float("nan"), 1.0]),
            (3, [float("inf"), 1.0]), (None, [1.0, 2.0]), (None, [9.0, 9.0]), (4, [-1.0, -2.0]), (150, [1e-300, 5.0, 7.0]), (-50, [-0.001, 0.0])]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows[:1]) == set() and found(spark, rows[:0]) == set()
    assert found(spark, rows, k=1, every=1) == plain(rows, 1, 1)


def test_scores_beyond_doubles_are_exact_and_beyond_longs_raise(spark):
    rows = [(0, [2.0**20 + 1, 1.0]), (1, [2.0**24 + 3, 1.0]), (2, [2.0**24 + 3, 1.004])]
    assert found(spark, rows) == plain(rows)
    with pytest.raises(Exception, match="do not fit a long"):
        found(spark, [(0, [2.0**30]), (1, [2.0**30])])


def test_a_row_without_essential_terms_cannot_reach_the_threshold():
    rng = np.random.default_rng(3)
    q, rows = rng.integers(-9, 9, 12), rng.integers(-9, 9, (500, 12))
    bounds = np.maximum(q * np.minimum(rows.min(0), 0), q * np.maximum(rows.max(0), 0))
    least = int(np.sort(rows @ q)[-5])
    main, others = maxscore.essential(bounds, least)
    assert sorted([*main, *others]) == list(range(12)) and bounds[others].sum() < least
    assert (np.maximum(rows[:, others] * q[others], 0).sum(1) < least).all()


def test_waves_cover_each_shard_once():
    for n in (1, 2, 5, 17, 1000):
        w = maxscore.waves(n)
        assert w[0][0] == 0 and w[-1][1] == n and all(a[1] == b[0] for a, b in zip(w, w[1:], strict=False))
        assert len(w) <= 2 + math.log(n, 4)
