"""Blocks of documents that ask for values by key and get them back.

Documents are dealt into blocks by hash; a row that is repeated so often that it would crowd its block goes there once, with a count. A block lists each key it needs once (a word, a pair of words), split into
parts by key and packed into one binary row a part; a part meets the requests of all blocks, works out each key's value
once, and answers every block in the block's own key order. Texts travel compressed. So what is shuffled grows with the distinct keys of blocks
and not with word occurrences, no task holds more than a block or a part, and nothing depends on row order.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlens.llm.common import ship
from viewlens.session import stored

ship(__name__)

BLOCK_BYTES = 8 << 20
PART_BYTES = 24 << 20
#: What a row takes besides its text.
ROW_BYTES = 64


def _bundled(docs: DataFrame, columns: list, block_bytes: int):
    """(rows with ``copies`` and a hash ``h``, bytes of all texts): rows that are repeated so often that they would crowd a block are one row.

    One narrow aggregate counts rows by hash of id and text. Those of which there is more than a quarter of a block (a row counts
    ROW_BYTES besides its text) are few, four a block at most, so their hashes can be sent to every task; their rows are collapsed
    map-side into one with a count."""
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select("doc_id", *columns, F.xxhash64("doc_id", "text").alias("h"), text)
    sizes = stored(rows.groupBy("h").agg(F.count("*").alias("n"), F.sum(F.octet_length("text") + F.lit(ROW_BYTES)).cast("long").alias("bytes"))
                   .withColumn("crowd", (F.col("n") > 1) & (F.col("bytes") > block_bytes // 4)), "block-sizes")
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    crowds = sizes.filter("crowd").select("h")
    if not crowds.isEmpty():
        each = rows.columns
        crowd = rows.join(F.broadcast(crowds), "h", "left_semi").groupBy(*each).agg(F.count("*").alias("copies"))
        rows = rows.join(F.broadcast(crowds), "h", "left_anti").withColumn("copies", F.lit(1).cast("long")).select(*each, "copies").unionByName(crowd)
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    return rows, int(total.b) - ROW_BYTES * int(total.n)


def dealt(docs: DataFrame, *columns, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES):
    """(rows with ``copies``, ``packed`` texts and a ``block``, number of parts). Sizes follow the data; the id and text decide the block."""
    rows, size = _bundled(docs, list(columns), block_bytes)
    blocks, parts = max(1, math.ceil(size / block_bytes)), max(1, math.ceil(size / part_bytes))
    names = [c for c in rows.columns if c not in ("h", "text", "copies")]
    rows = rows.select(*names, "copies", F.pmod("h", F.lit(blocks)).cast("int").alias("block"), "text")
    names = rows.columns[:-1]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)

    def compress(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = batch.column(len(names)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))),
                                              pa.array([squeeze(x) for x in texts.to_pylist()], pa.binary())], [*names, "packed"])

    return rows.mapInArrow(compress, f"{kinds}, packed binary"), parts


def apart(rows: DataFrame) -> DataFrame:
    """A row for each of a row's ``copies``."""
    some = F.when(F.col("copies") > 1, F.sequence(F.lit(1).cast("long"), F.col("copies"))).otherwise(F.array(F.lit(1).cast("long")))
    return rows.withColumn("copies", F.explode(some)).drop("copies")


def texts_of(table: pa.Table) -> pa.Array:
    """The texts of a block's rows."""
    import zstandard

    restore = zstandard.ZstdDecompressor().decompress
    return pa.array([restore(x) for x in table["packed"].to_pylist()], pa.binary()).cast(pa.string(), safe=False)


def pack_ints(a: np.ndarray, delta: bool = False) -> bytes:
    """Unsigned integers in the fewest bytes, byte planes apart; ``delta`` for ascending ones."""
    import zstandard

    a = np.ascontiguousarray(a, np.uint64)
    if delta and len(a):
        a = np.diff(a, prepend=np.uint64(0))
    most = int(a.max()) if len(a) else 0
    kind = np.dtype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max))
    planes = a.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T
    return bytes([kind.itemsize]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_ints(b: bytes, delta: bool = False) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(b[0], -1)
    a = np.ascontiguousarray(planes.T).view(f"<u{b[0]}").ravel().astype(np.uint64)
    return np.cumsum(a, dtype=np.uint64) if delta else a


def pack_floats(a: np.ndarray) -> bytes:
    return pack_ints(np.ascontiguousarray(a, np.float32).view(np.uint32))


def unpack_floats(b: bytes) -> np.ndarray:
    return unpack_ints(b).astype(np.uint32).view(np.float32).astype(np.float64)
