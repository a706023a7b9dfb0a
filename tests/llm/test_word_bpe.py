import collections
import hashlib
import json

import public_tokenizers
import pytest
from frames import EDGE, SF, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from viewlens.llm import blocks, word_bpe
from viewlens.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
SPECIAL = [(20, "x<|endoftext|>y <|startoftext|>"), (21, "don't A'S é ́ \xa0\x85z"), (22, "﻿ ​ \xad"), (23, "y" * 50000)]


def want(text):
    t = Tokenizer.from_file(PATH)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def test_tables(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_word_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, text = want(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_edges(spark):
    rows = EDGE + SPECIAL
    got = word_bpe.encode(documents(spark, rows), PATH).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=key) == sorted(((i, *want(t)) for i, t in rows), key=key)
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_many_blocks_and_parts_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = sorted(map(tuple, word_bpe.encode_digests(docs, PATH).collect()))
    monkeypatch.setattr(word_bpe, "dealt", lambda d, **_: blocks.dealt(d, block_bytes=1 << 16, part_bytes=1 << 17))
    assert sorted(map(tuple, word_bpe.encode_digests(docs, PATH).collect())) == one


def test_empty(spark):
    assert word_bpe.encode_digests(documents(spark).limit(0), PATH).count() == 0


def test_other_vocabularies_are_refused(spark, tmp_path):
    with open(PATH) as f:
        file = json.load(f)
    spaced = file | {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}
    decoding = file | {"decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}
    for k, other in enumerate((spaced, decoding)):
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps(other))
        with pytest.raises(ValueError, match="vocabulary"):
            word_bpe.encode(documents(spark), str(path))


def test_repeated_rows_do_not_crowd_a_block(spark, monkeypatch):
    """A third of all rows is one row: it is in its block once, with a count, and comes out as often as it went in."""
    rows = [(7, "a text that is everywhere " * 3)] * 3000 + [(None, None)] * 500 + [(i, f"text number {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt, _ = blocks.dealt(docs, block_bytes=1 << 16)
    assert dealt.count() == 3002 and dealt.agg(F.sum("copies")).first()[0] == len(rows)
    assert max(r.n for r in dealt.groupBy("block").agg(F.count("*").alias("n")).collect()) < 1500
    monkeypatch.setattr(word_bpe, "dealt", lambda d, **_: blocks.dealt(d, block_bytes=1 << 16, part_bytes=1 << 17))
    got = collections.Counter((r.doc_id, tuple(r.ids)) for r in word_bpe.encode(docs, PATH).collect())
    assert got[7, tuple(want(rows[0][1])[0])] == 3000 and got[None, ()] == 500 and sum(got.values()) == len(rows)
