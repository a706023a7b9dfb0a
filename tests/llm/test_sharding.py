import zlib

from frames import EDGE, SF, documents
from pyspark.sql import functions as F
from viewlens.llm import sharding


def check(rows, texts, shards):
    want = sorted((i is not None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == want
    total, most = sum(r.size for r in rows), max(r.size for r in rows)
    last = None
    for s in range(shards):
        own = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= most
        ids = [r.doc_id for r in own if r.doc_id is not None]
        if ids and last is not None:
            assert min(ids) >= last  # contiguous
        last = max(ids, default=last)


def test_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard(docs).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 24)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_reader_may_merge_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(6)
    out = sharding.shard(docs)
    assert sorted(map(tuple, out.coalesce(1).collect())) == sorted(map(tuple, out.collect()))
    check(out.union(out.limit(0)).coalesce(2).collect(), [(r.doc_id, r.text) for r in docs.collect()], 24)


def test_edges(spark):
    check(sharding.shard(documents(spark), 3).collect(), EDGE, 3)
    check(sharding.shard(documents(spark, [(1, "same")] * 50), 7).collect(), [(1, "same")] * 50, 7)
    assert sharding.shard(documents(spark).limit(0)).count() == 0


def test_copies_of_one_row_spread_over_runs(spark):
    """A third of all rows is one row: no run holds more of them than its share, and the law holds."""
    rows = [(7, "the same text")] * 6000 + [(i, f"text {i} " * (i % 9)) for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = [r.n for r in sharding.ordered(docs).groupBy("p").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(held) > 4 and max(held) <= 2 * len(rows) / len(held)
    out = sharding.shard(docs).collect()
    assert len(out) == len(rows) and sum(r.doc_id == 7 and r.size == 21 for r in out) >= 6000
    size, slots = {}, {}
    for r in out:
        size[r.shard] = size.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert max(size.values()) - min(size.values()) <= 2 * max(r.size for r in out)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
