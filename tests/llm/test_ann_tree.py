import math
import random

import numpy as np
import pytest
from frames import CLASHING
from pyspark.sql import functions as F
from viewlens.llm import ann_tree
from viewlens.llm.queries import QUERIES


def frame(spark, rows):
    clash = {c: F.lit("clash") for c in CLASHING if c != "score"} | {"leaf": F.lit(1), "query_id": F.lit(2)}
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(clash)


def plain(rows, k=5, every=50):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % every == 0:
            near = sorted((-(v @ w) / math.sqrt(v @ v) / math.sqrt(w @ w), i) for i, w in ok if i != q)[:k]
            out[q] = [(n + 1, i, pytest.approx(-s, abs=1e-9)) for n, (s, i) in enumerate(near)]
    return out


def by_query(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = by_query(QUERIES["op5_kmeans_tree_search"](spark, sf).collect()), plain(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({x[1] for x in got[q]} & {x[1] for x in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 8, "chunk": 16, "sample": 64, "recall": 1.0, "calibration": 10**6}])
def test_ties_crowded_places_and_bad_rows(spark, options):
    rng = random.Random(4)
    near = [1.0, 2.0, 0.5, -1.0]
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(150)]
    rows += [(i, near) for i in range(200, 260)] + [(i, [2 * x for x in near]) for i in range(300, 320)]  # one direction, many rows
    rows += [(400, None), (450, []), (500, [0.0] * 4), (550, [1.0, None, 0.0, 1.0]), (600, [1.0, float("nan"), 0.0, 1.0]),
             (650, [float("inf"), 0.0, 0.0, 1.0]), (700, [1.0, 2.0])]
    want = plain([r for r in rows if r[0] < 700])
    got = by_query(ann_tree.search(frame(spark, rows + [(None, near)]), **options).collect())
    if options:
        assert got == want
    assert got.keys() == want.keys()
    assert [x[1] for x in got[200]] == [201, 202, 203, 204, 205]


def test_few_rows(spark):
    assert by_query(ann_tree.search(frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0])])).collect()) == plain([(0, [1.0, 0.0]), (1, [1.0, 1.0])])
    assert ann_tree.search(frame(spark, [(0, [1.0, 0.0])])).count() == 0
    assert ann_tree.search(frame(spark, [(0, [1.0])]).limit(0)).count() == 0


def test_a_query_in_a_sparse_leaf_still_gets_k(spark):
    rng = random.Random(8)
    middle = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(20)]
    rows = [(i, [x + rng.gauss(0, 0.01) for x in middle[i % 20]]) for i in range(1, 900)]
    rows += [(1000 + 50 * i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(30)]  # far from all others
    got = by_query(ann_tree.search(frame(spark, rows), leaf_rows=8, recall=0.5).collect())
    assert got.keys() == plain(rows).keys()
    assert {q: [x[0] for x in v] for q, v in got.items()} == {q: [1, 2, 3, 4, 5] for q in got}


def plain_ids(rows, k=5, every=50):
    """The k best other ids of each id, each pair of ids by its best pair of vectors."""
    of = {}
    for i, v in rows:
        if i is not None:
            of.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    score = lambda a, b: max(v @ w / math.sqrt(v @ v) / math.sqrt(w @ w) for v in of[a] for w in of[b])
    out = {}
    for q in of:
        if q % every == 0:
            near = sorted((-score(q, i), i) for i in of if i != q)[:k]
            out[q] = [(n + 1, i, pytest.approx(-s, abs=1e-9)) for n, (s, i) in enumerate(near)]
    return out


EXACT = {"leaf_rows": 8, "chunk": 16, "sample": 64, "recall": 1.0, "calibration": 10**6}


def test_repeated_rows_and_ids_with_several_vectors(spark):
    rng = random.Random(6)
    vector = lambda: [rng.gauss(0, 1) for _ in range(4)]
    rows = [(i, vector()) for i in range(200)]
    several = rows + [(i, vector()) for i in (0, 50, 7, 7, 7)] + [(50, [2 * x for x in rows[50][1]])]
    nulls = [(None, v) for _, v in rows[:40]]
    for options in ({}, EXACT):
        assert by_query(ann_tree.search(frame(spark, rows * 5 + nulls), **options).collect()) == by_query(ann_tree.search(frame(spark, rows), **options).collect())
    assert by_query(ann_tree.search(frame(spark, rows * 5 + nulls), **EXACT).collect()) == plain_ids(rows)
    assert by_query(ann_tree.search(frame(spark, several * 2 + nulls), **EXACT).collect()) == plain_ids(several)


def test_best_bin_first_opens_leaves_from_near_to_far():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 2)).astype(np.float32)
    nodes, leaves = ann_tree.build(x, 10, branch=4)
    assert leaves > 16
    for q in x[:20]:
        order = ann_tree.visits(q, nodes, leaves)
        assert sorted(order) == list(range(leaves)) and order[:5] == ann_tree.visits(q, nodes, 5)
    own = ann_tree.leaf_of(x, nodes)
    first = [ann_tree.visits(q, nodes, 1)[0] for q in x]
    assert np.mean(own == first) > 0.8
