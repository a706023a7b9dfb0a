"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word: a run of code points that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ship(name: str) -> None:
    """Send the functions of module ``name`` to Python workers by value (they need not have this package)."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)


def word_count(text: Column) -> Column:
    """Words of a text; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id is the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(df: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of a text column, to size partitions by data."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(col)), F.lit(0))).first()[0])


def give_back() -> None:
    """Freed memory of Arrow and, with glibc, of the C heap goes back to the system: a Python worker lives on beside the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, col: str = "text", limit: int = 1 << 20, rows: int = 1 << 20):
    """Cuts of a batch whose texts hold ``limit`` bytes at most (one row at least), with ``rows`` rows at most.

    Work on a slice takes some 30 times its bytes; what is left of that is given back after each batch."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(col))), 0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (total + n > limit or i - start >= rows):
            yield batch.slice(start, i - start)
            total, start = 0, i
        total += n
    yield batch.slice(start)
    give_back()


def split_words(texts: pa.Array, lower: bool = False):
    """(offsets, words): row i has words[offsets[i]:offsets[i + 1]]; a null text has none.

    Splits at ASCII white space; ``lower`` folds A-Z only.
    """
    texts = pc.fill_null(texts, "")
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts) if lower else texts)
    lists = pc.ascii_split_whitespace(texts)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets -= offsets[0]
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
    if empty.any():  # the one word of an empty text
        gone = np.concatenate([[0], np.cumsum(empty)])
        words, offsets = words.filter(pa.array(~empty)), offsets - gone[offsets]
    return offsets, words


def coded(words: pa.Array):
    """(codes, vocabulary) of a word array."""
    if not len(words):
        return np.zeros(0, np.int64), pa.array([], pa.string())
    d = words.dictionary_encode()
    if isinstance(d, pa.ChunkedArray):
        d = d.combine_chunks()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = np.asarray(x, np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_ODD = 0x9E3779B97F4A7C15


def hash_words(vocabulary: pa.Array) -> np.ndarray:
    """64-bit hashes of words, the same in every process: a polynomial in random byte codes, modulo 2^64, then mixed."""
    n = len(vocabulary)
    if not n:
        return np.zeros(0, np.uint64)
    if isinstance(vocabulary, pa.ChunkedArray):
        vocabulary = vocabulary.combine_chunks()
    at = np.frombuffer(vocabulary.buffers()[1], np.int32, n + 1, vocabulary.offset * 4).astype(np.int64)
    if at[-1] == at[0]:
        return mix64(np.zeros(n, np.uint64))
    data = np.frombuffer(vocabulary.buffers()[2], np.uint8)[at[0]:at[-1]]
    at -= at[0]
    codes = mix64(np.arange(256), 1)
    size = int(np.diff(at).max()) + 1
    powers = np.cumprod(np.full(size, _ODD, np.uint64))
    place = np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes[data] * powers[place], dtype=np.uint64)])
    return mix64((total[at[1:]] - total[at[:-1]]) ^ np.diff(at).astype(np.uint64))
