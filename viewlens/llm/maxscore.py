"""Exact top-k search by inner product with MaxScore over shards.

A vector's components are its term weights: ``floor(256 * x)``, an integer for each dimension. A shard holds a bounded number of
components, as one posting list a dimension, and the least and largest weight of each list. A query bounds what each of its terms can
add in a shard. With ``t`` the query's k-th best score so far, the terms of the least bounds that together stay below ``t`` are
non-essential: a row that only they lift cannot compete. The postings of the essential terms are traversed for all rows; the rows that
can still reach ``t`` are probed in the other lists, largest bound first, while they can. Segments of a shard go one after the other, so
``t`` rises on the way. Shards are searched in waves, each several times as large as all before it, and start from the k-th best of the
merged results of the waves before; so a query returns about as many rows a wave however many shards there are.

Equal vectors are one posting with the ``k + 1`` least of its ids, which is all that any query can return of them. All sums are exact.

Defined cases: vectors that are null or hold null or non-finite components take no part; a vector counts 0 beyond its length, so vectors
of other lengths and empty ones take part; rows of one id are one candidate, at its best score, and one query that asks by each of its
vectors, and are no candidates of each other; rows without an id are one candidate, last in ties, and nobody's own row; ties go to the
smaller vec_id; with fewer than ``k`` candidates all are returned; a score that does not fit a long raises; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlens.llm.common import ship
from viewlens.session import stored

ship(__name__)

K = 5
EVERY = 50
SCALE = 256
#: Least and most components of a shard and of a block of queries. In between they grow with the data, to SHARDS shards and BLOCKS blocks.
SHARD = (1 << 18, 1 << 22)
BLOCK = (1 << 15, 1 << 19)
SHARDS, BLOCKS = 64, 8
#: Rows of a segment, queries whose essential postings are traversed at once.
SEGMENT = 4096
BATCH = 64
#: A wave searches so many times the shards of all waves before it.
GROWTH = 3
#: Below it sums of integers are exact in double precision.
EXACT = 1 << 53
LONG = 1 << 63


def weights(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, w: integer term weights of the rows that take part, each (id, vector) once."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = vectors.select("vec_id", F.when(~bad, x).alias("x")).filter(F.col("x").isNotNull())
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("w")).distinct()


def _class(w: Column) -> Column:
    """The power of two that a vector's length does not exceed."""
    return F.ceil(F.log2(F.greatest(F.size(w), F.lit(1)))).cast("int")


def postings(rows: DataFrame, k: int = K) -> DataFrame:
    """w, ids (its k + 1 least, null last), c: a row per distinct vector. The window keeps k + 1 rows a task before the shuffle."""
    order = Window.partitionBy("w").orderBy(F.col("vec_id").asc_nulls_last())
    few = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    ids = F.sort_array(F.collect_list(F.struct("place", "vec_id")))
    return few.groupBy("w").agg(F.transform(ids, lambda i: i["vec_id"]).alias("ids")).withColumn("c", _class(F.col("w")))


def _numbered(rows: DataFrame, by: list[str], bounds: tuple[int, int], aim: int) -> tuple[DataFrame, int]:
    """``rows`` with a ``part`` by hash of the distinct values ``by``; the number of parts: ``aim``, within the bounds of their components.

    Vectors of one length class share parts, so that padding at most doubles them. A row per class reaches the driver."""
    sizes = rows.groupBy("c").count().collect()
    least, most = bounds
    components = min(most, max(least, sum(r["count"] << r.c for r in sizes) // aim))
    first, total = {}, 0
    for r in sorted(sizes):
        parts = math.ceil((r["count"] << r.c) / components)
        first[r.c] = (total, parts)
        total += parts
    if not total:
        return rows.withColumn("part", F.lit(0)), 0
    part = None
    for c, (at, parts) in first.items():
        here = F.lit(at) + F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int")
        part = F.when(F.col("c") == c, here) if part is None else part.when(F.col("c") == c, here)
    return rows.withColumn("part", part), total


def _padded(lists: pa.Array) -> np.ndarray:
    """The lists as rows of an integer matrix, 0 beyond their length."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _narrow(w: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes."""
    least, most = int(w.min(initial=0)), int(w.max(initial=0))
    return w.astype(next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= least and most <= np.iinfo(k).max))


def _one(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _lists(column) -> list:
    return _one(column).to_pylist()


def pack_shard(key, table):
    """A part's vectors in one row: posting lists (dimensions by rows) and the ids of each row."""
    w = _narrow(_padded(_one(table["w"])).T)
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "width": pa.array([w.itemsize], pa.int32()),
                     "lists": pa.array([w.tobytes()], pa.binary()),
                     "ids": pa.array([_lists(table["ids"])], pa.list_(pa.list_(pa.int64())))})


def pack_block(key, table):
    w = _narrow(_padded(_one(table["w"])))
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "own": pa.array([_lists(table["vec_id"])], pa.list_(pa.int64())),
                     "width": pa.array([w.itemsize], pa.int32()), "w": pa.array([w.tobytes()], pa.binary()),
                     "least": pa.array([_lists(table["least"])], pa.list_(pa.int64()))})


def essential(bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(essential terms, the others by falling bound): the others' bounds, the least ones, add up to less than ``least``."""
    order = np.argsort(bounds, kind="stable")
    split = int(np.searchsorted(np.cumsum(bounds[order]), least, side="left"))
    return order[split:], order[:split][::-1]


class _Best:
    """A query's best ids so far, by falling score and rising id (null last), and the score that the next one has to reach."""

    def __init__(self, own: int, least: int | None, k: int):
        self.own, self.k, self.found, self.least = own, k, {}, least

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: list) -> None:
        order = np.argsort(-scores, kind="stable")
        met, at = set(), 0
        for at, j in enumerate(order.tolist()):
            if len(met) >= self.k and scores[j] < scores[order[at - 1]]:  # ties with the last one needed are read to their end
                break
            s = int(scores[j])
            for i in ids[rows[j]]:
                if i != self.own:
                    met.add(i)
                    if s > self.found.get(i, -LONG):
                        self.found[i] = s
        if len(self.found) >= self.k:
            best = sorted(self.found.items(), key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:self.k]
            self.found = dict(best)
            self.least = max(best[-1][1], -LONG if self.least is None else self.least)


def search_cell(lists: np.ndarray, ids: list, queries: np.ndarray, own: list, least: list, k: int = K):
    """(query number, id, score) of what a shard adds to each query's k best."""
    d = min(lists.shape[0], queries.shape[1])
    lists, queries = lists[:d], queries[:, :d]  # the rest meets only zeros
    low, high = lists.min(1, initial=0), lists.max(1, initial=0)
    most = np.maximum(np.abs(low.astype(float)), np.abs(high.astype(float)))
    reach = float((np.abs(queries.astype(float)) @ most).max(initial=0))
    if reach >= LONG / 2:
        raise ValueError("inner products do not fit a long")
    kind = np.float64 if reach < EXACT else np.int64
    lists, terms = lists.astype(kind), queries.astype(kind)
    bounds = np.maximum(queries * low, queries * high)  # at least 0, as low <= 0 <= high
    best = [_Best(o, t, k) for o, t in zip(own, least, strict=True)]
    for a in range(0, lists.shape[1], SEGMENT):
        segment = lists[:, a:a + SEGMENT]
        for b in range(0, len(terms), BATCH):
            some = range(b, min(b + BATCH, len(terms)))
            split = [essential(bounds[i], -LONG if best[i].least is None else best[i].least) for i in some]
            heads = np.zeros((len(split), d), kind)
            for j, (i, (main, _)) in enumerate(zip(some, split, strict=True)):
                heads[j, main] = terms[i, main]
            partial = heads @ segment
            for j, (i, (_, others)) in enumerate(zip(some, split, strict=True)):
                t, rest, score = best[i].least, bounds[i][others], partial[j]
                left = np.cumsum(rest[::-1])[::-1].tolist() + [0]  # what the lists not probed yet can add
                rows = np.arange(len(score)) if t is None else np.flatnonzero(score + left[0] >= t)
                score = score[rows]
                for n, dim in enumerate(others.tolist()):
                    if not len(rows):
                        break
                    score = score + terms[i, dim] * segment[dim, rows]
                    fit = score + left[n + 1] >= t
                    if not fit.all():
                        rows, score = rows[fit], score[fit]
                if len(rows):
                    best[i].add(rows + a, score.astype(np.int64), ids)
    return [(i, v, s) for i, q in enumerate(best) for v, s in q.found.items()]


def _vectors(data: bytes, width: int, n: int, by_dimension: bool = False) -> np.ndarray:
    """What was packed of ``n`` vectors."""
    flat = np.frombuffer(data, f"<i{width}").astype(np.int64)
    return flat.reshape((len(flat) // n, n) if by_dimension else (n, len(flat) // n))


def _cell(k: int):
    """A shard's row met with a block's row."""
    def run(key, shard, block):
        found = []
        for s in shard.to_pylist():
            for q in block.to_pylist():
                lists, queries = _vectors(s["lists"], s["width"], len(s["ids"]), True), _vectors(q["w"], q["width"], len(q["own"]))
                found += [(q["own"][i], v, x) for i, v, x in search_cell(lists, s["ids"], queries, q["own"], q["least"], k)]
        return pa.table({c: pa.array([r[j] for r in found], pa.int64()) for j, c in enumerate(("query_id", "vec_id", "score"))})
    return run


def merged(found: DataFrame, k: int = K) -> DataFrame:
    """Each query's k best ids: query_id, rank, vec_id, score."""
    each = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def waves(shards: int, growth: int = GROWTH) -> list[tuple[int, int]]:
    """(first shard, end) of each wave."""
    out, at = [], 0
    while at < shards:
        end = min(shards, max(1, at * (1 + growth)))
        out.append((at, end))
        at = end
    return out


def top(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, shard=SHARD, block=BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query."""
    spark = vectors.sparkSession
    rows = stored(weights(vectors, scale), "maxscore-weights")
    index, shards = _numbered(stored(postings(rows, k), "maxscore-postings"), ["w"], shard, SHARDS)
    asking = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).withColumn("c", _class(F.col("w")))
    asking, blocks = _numbered(asking, ["vec_id", "w"], block, BLOCKS)
    best = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not (shards and blocks):
        return best
    packed = stored(index.groupBy("part").applyInArrow(pack_shard, "part int, width int, lists binary, ids array<array<long>>"), "maxscore-shards")
    for first, end in waves(shards):
        least = best.groupBy("query_id").agg(F.min(F.when(F.col("rank") == k, F.col("score"))).alias("least"))
        known = asking.join(least, asking.vec_id == least.query_id, "left").select("part", "vec_id", "w", "least")
        asked = known.groupBy("part").applyInArrow(pack_block, "block int, own array<long>, width int, w binary, least array<long>")
        # a cell is a shard and a block of queries: every block goes to every shard of the wave and is met there once
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(first), F.lit(end - 1))))
        wave = packed.filter((F.col("part") >= first) & (F.col("part") < end)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        found = wave.groupBy("part", "block").cogroup(asked.groupBy("part", "block")).applyInArrow(_cell(k), "query_id long, vec_id long, score long")
        best = stored(merged(found.unionByName(best.select("query_id", "vec_id", "score")), k), "maxscore-best")
    return best
