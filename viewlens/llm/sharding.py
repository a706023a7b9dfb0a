"""Contiguous shards of near-equal bytes from prefix sums of partition totals.

Rows are counted by id, size and checksum, range-partitioned by these, sorted inside partitions and written once, narrow. Each
partition reports its rows and bytes; running totals of these (a row per partition) give every partition its global offset, and
a second read gives every row its offset. A row belongs to the shard in which its first byte falls when all bytes are cut into
equal parts, so a shard differs from its target by less than one row. No group of rows is needed in one task: equal ids spread by
their text's checksum, and the copies of one row by their numbers.

Defined cases: a null text has no bytes and checksum 0; every row weighs its bytes plus 8; null ids come first; repeated
rows are separate, in any order among themselves; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlens.llm.common import ship
from viewlens.session import stored

ship(__name__)

SHARDS = 24
ROW_BYTES = 8
#: Most copies of a row that one task makes from their count.
BUNDLE = 1000


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, p in global order; ``p`` numbers the sorted runs, which every later read gives whole and in order.

    Rows that are equal in all three are counted and numbered, so the copies of one row are spread over runs like other rows; those of
    a row with more than BUNDLE copies are made in as many tasks."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    key = ["doc_id", "text_crc32", "size"]
    counted = rows.groupBy(*key).agg(F.count("*").alias("n"))
    few = counted.filter(F.col("n") <= BUNDLE).select(*key, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    bundle = F.explode(F.sequence(F.lit(1), F.col("n"), F.lit(BUNDLE))).alias("bundle")
    many = counted.filter(F.col("n") > BUNDLE).select(*key, "n", bundle).repartition(*key, "bundle")
    many = many.select(*key, F.explode(F.sequence("bundle", F.least(F.col("n"), F.col("bundle") + (BUNDLE - 1)))).alias("copy"))
    runs = few.unionByName(many).repartitionByRange(*key, "copy").sortWithinPartitions(*key, "copy")
    return stored(runs.select("doc_id", "size", "text_crc32", F.spark_partition_id().alias("p")), "shard-runs")


def _offsets(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Rows and bytes before each run: a bounded list, one entry per partition."""
    totals = rows.groupBy("p").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()
    out, n, b = {}, 0, 0
    for r in sorted(totals, key=lambda r: r.p):
        out[r.p] = (n, b)
        n, b = n + r.n, b + r.b
    return out | {-1: (n, b)}


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = ordered(docs)
    offsets = _offsets(rows)
    total = max(1, offsets[-1][1])

    def place(batches):
        run, n, b = None, 0, 0
        for whole in batches:
            runs = whole.column("p").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(runs)]
            for batch, of in ((whole.slice(x, y - x), int(runs[x])) for x, y in zip(cuts[:-1], cuts[1:], strict=True) if y > x):
                if of != run:  # a task may read several runs, one after the other
                    run, (n, b) = of, offsets[of]
                yield placed_rows(batch, n, b)
                n, b = n + batch.num_rows, b + int(batch.column("size").to_numpy().sum())

    def placed_rows(batch, n, b):
        size = batch.column("size").to_numpy()
        starts = b + np.cumsum(size) - size
        cut = np.minimum((starts // total) * shards + (starts % total) * shards // total, shards - 1)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("size"), batch.column("text_crc32"), pa.array(cut.astype(np.int32)),
             pa.array(np.arange(n, n + len(size), dtype=np.int64))], ["doc_id", "size", "text_crc32", "shard", "row"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    placed = rows.mapInArrow(place, f"doc_id {kind}, size long, text_crc32 long, shard int, row long")
    first = {r.shard: r.row for r in placed.groupBy("shard").agg(F.min("row").alias("row")).collect()}  # one row per shard
    starts = F.element_at(F.array(*[F.lit(first.get(k, 0)).cast("long") for k in range(shards)]), F.col("shard") + 1)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - starts).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
