import numpy as np
import pyarrow as pa
import pytest
from frames import EDGE, documents
from viewlens.llm import fm_quality
from viewlens.llm.queries import QUERIES


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op8_fm_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 500
    good, bad = [r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]
    better = np.mean([[g > b for b in bad] for g in good])
    assert better >= 0.98
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([s >= 0.7 for s in good]) >= 0.98 and np.mean([s < 0.7 for s in bad]) >= 0.95


def test_pairs_in_linear_time_are_all_pairs():
    rng = np.random.default_rng(3)
    x, w, v = rng.random((5, 7)).astype(np.float32), rng.standard_normal(7).astype(np.float32), rng.standard_normal((7, 3)).astype(np.float32)
    got = fm_quality.score_rows(x, (0.3, w, v, (v**2).sum(1)))
    for row, s in zip(x, got, strict=True):
        z = 0.3 + row @ w + sum(v[i] @ v[j] * row[i] * row[j] for i in range(7) for j in range(i))
        assert s == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (None, 1), (7, None), (999, 1), (9, 0)], "doc_id long, quality int")
    model = fm_quality.train(docs, labels)
    rows = fm_quality.score(docs, model).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    kept = fm_quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    assert fm_quality.keep_good(docs.drop("n_chars"), model).columns == docs.drop("n_chars").columns
    assert fm_quality.score(docs.limit(0), model).count() == 0
    none = fm_quality.train(docs, labels.limit(0))
    assert none is None and {(r.score, r.predicted) for r in fm_quality.score(docs, none).collect()} == {(0.5, 0)}


def test_a_repeated_document_is_fitted_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(fm_quality, "fit", lambda x, y: seen.append((len(x), x.sum().item(), y.sum().item())))
    ids = [i for i in range(40) if __import__("zlib").crc32(str(i).encode()) % 4 != 2]
    once = [(i, f"text of {i}") for i in ids]
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[1], 1)], "doc_id long, quality int")
    for rows in (once, once + once[:1] * 200):
        fm_quality.train(documents(spark, rows), labels)
    assert seen[0][0] == len(ids) + 1 and seen[1] == seen[0]


def test_a_text_scores_the_same_in_any_slice():
    texts = [t for _, t in EDGE]
    x = fm_quality.features(pa.array(texts, pa.string()), np.zeros(len(texts)))
    for i, t in enumerate(texts):
        assert np.allclose(x[i], fm_quality.features(pa.array([t], pa.string()), np.zeros(1))[0], atol=1e-6)
