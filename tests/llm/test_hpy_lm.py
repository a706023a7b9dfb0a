import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from frames import EDGE, SF, documents
from viewlens.llm import blocks, hpy_lm
from viewlens.llm.queries import QUERIES


def tokens(text):
    low = (text or "").translate({65 + i: 97 + i for i in range(26)})
    return [w for w in re.split(r"[\x20\x09-\x0d]+", low) if w] + [None]


def out_of_sample(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def check(rows, texts):
    count = collections.Counter()
    for i, t in texts:
        if not out_of_sample(i):
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in texts:
        own = tokens(t)
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in own)
        want.append((str(i), out_of_sample(i), len(own), sum(count[x] > 0 for x in own), n, round(base, 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score <= 1e-6 for r in rows)


def test_tables(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op4_pitman_yor_score"](spark, SF).collect()
    check(rows, texts)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # better than the base on texts it has not seen
    assert sum(r.score for r in rows if not r.held_out) > sum(r.base_score for r in rows if not r.held_out)


def test_many_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(hpy_lm, "BLOCK_BYTES", 1 << 16)
    monkeypatch.setattr(hpy_lm, "PART_BYTES", 1 << 16)
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(QUERIES["op4_pitman_yor_score"](spark, SF).collect(), texts)


def test_repeated_rows_count_each(spark, monkeypatch):
    monkeypatch.setattr(hpy_lm, "BLOCK_BYTES", 1 << 14)
    rows = [(7, "a text that is everywhere " * 3)] * 900 + [(6, "held out or not")] * 400 + [(i, f"text number {i}") for i in range(900)]
    check(hpy_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_edges(spark):
    check(hpy_lm.score(documents(spark)).collect(), EDGE)
    only = [i for i in range(50) if out_of_sample(i)][:3]
    rows = hpy_lm.score(documents(spark, [(i, "nothing learnt") for i in only])).collect()
    assert [(r.base_score, r.score, r.train_tokens) for r in rows] == [(0.0, pytest.approx(0, abs=1e-6), 0)] * 3
    assert hpy_lm.score(documents(spark).limit(0)).count() == 0


def test_probabilities_of_a_context_add_up_to_one():
    """All words that can follow a known context, and one unknown word."""
    import zstandard

    known = ["a", "b", "c", "d"]
    learn = ["a b a b c a b", "b b c d", "a a a b", "d"]
    ask = [f"{u} {w}" for u in known for w in [*known, "unknown"]]
    texts, bits = [*learn, *ask], 40
    table = pa.table({"packed": pa.array([zstandard.compress(t.encode()) for t in texts], pa.binary()),
                      "held_out": pa.array([False] * len(learn) + [True] * len(ask)), "copies": pa.array([1] * len(texts), pa.int64())})
    key = (pa.scalar(0, pa.int32()),)
    asked = hpy_lm._request(bits, 1)(key, table)
    answers = hpy_lm._with_globals(hpy_lm._answer_first)(key, hpy_lm._first_tables(bits, 1)(key, asked))
    sampled = hpy_lm._answer_sampled(key, hpy_lm._sampled_tables(bits, 1)(key, asked, answers))
    logs = blocks.unpack_floats(hpy_lm._answer_blocks(key, asked, pa.concat_tables([answers, sampled]))["logs"][0].as_py())
    _, hashes, context, word = hpy_lm.pairs_of(pa.array(texts), bits)
    pairs = np.unique(context * len(hashes) + word)
    of = np.searchsorted(hashes, np.maximum(hpy_lm.hash_words(pa.array(known)) >> np.uint64(64 - bits), np.uint64(2)))
    for u in of:
        assert (10 ** logs[pairs // len(hashes) == u]).sum() == pytest.approx(1, abs=1e-4)


def test_seating_has_the_expected_number_of_tables():
    rng, n, rate, discount = np.random.default_rng(1), 200, 2.0, 0.5
    expect = 1.0
    spread = {1: 1.0}  # the exact distribution of tables
    for j in range(1, n):
        after = collections.defaultdict(float)
        for t, p in spread.items():
            new = rate / (rate + j - discount * t)
            after[t + 1] += p * new
            after[t] += p * (1 - new)
        spread = after
    expect = sum(t * p for t, p in spread.items())
    drawn = hpy_lm.seat(np.full(20000, float(n)), np.full(20000, rate), discount, rng)
    assert drawn.mean() == pytest.approx(expect, rel=0.02)
    assert hpy_lm.seat(np.array([0.0, 1.0]), np.ones(2), 0.5, rng).tolist() == [0, 1]
