"""Approximate nearest neighbours by cosine: hierarchical k-means tree, best-bin-first.

The tree is fitted on a bounded sample of unit vectors (``sample`` rows by hash of the id) and is small enough to be sent to
every task. Every row is put into a leaf. A query walks the tree with a priority queue that always opens the nearest
unopened node, and so visits leaves in widening order. How many leaves to visit is calibrated: for a bounded set of queries
the exact neighbours are found among all rows, their leaves' places in the query's order are looked up, and visits widen until the target
recall is met. A query whose leaves hold fewer than ``k`` other ids goes on until they do, so that each gets all that it can. Neighbouring leaves are packed into places of bounded rows, where rows meet the queries that visit one of their leaves; a
place returns each query's best rows among the leaves it visits. A leaf with many rows, or a place with many queries, is cut into
chunks over many tasks, so a crowded place costs no task more than a chunk pair. Candidates are scored exactly, in double precision, on the original vectors.

Each id is one candidate, at its best score: repeated rows of an id and vector are one row, dropped before the index is built; an id with
several vectors is found, and asks, by each of them, and has ``k`` other ids as its answer.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, take no part, nor do rows with a null id, nor
those whose length differs from the commonest of the distinct rows (the least of equals); rows with equal id are each other's
"own row" and no candidates; ties go to the smaller vec_id; with fewer than ``k`` candidates all are returned; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewlens.llm.common import ship
from viewlens.session import materialize, stored

ship(__name__)

K = 5
EVERY = 50
SAMPLE = 16384
LEAF_ROWS = 128
BRANCH = 16
CALIBRATION = 256
TARGET_RECALL = 0.97
#: Rows and queries of one chunk pair.
CHUNK = 4096


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of double) of the rows that take part."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad & F.exists("embedding", lambda x: x != 0))
    common = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()  # one row
    return rows.filter(F.size("embedding") == F.lit(common.d if common else 0))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = (x @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)
        for c in range(k):
            if (own == c).any():
                centres[c] = x[own == c].mean(0)
    return centres


def build(x: np.ndarray, leaf: int, branch: int = BRANCH, seed: int = 5):
    """The tree as a list of nodes (centres, children); a child of -1 - i is leaf i. Splits until ``leaf`` sample rows."""
    rng, nodes, leaves = np.random.default_rng(seed), [], 0
    todo = [(np.arange(len(x)), None, 0)]
    if len(x) <= leaf:
        return [(x.mean(0, keepdims=True) if len(x) else np.zeros((1, 1), np.float32), [-1])], 1
    while todo:
        rows, parent, at = todo.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][1][at] = me
        k = min(branch, max(2, math.ceil(len(rows) / leaf)))
        centres = _kmeans(x[rows], k, rng)
        own = (x[rows] @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)
        nodes.append((centres, [0] * k))
        for c in range(k):
            part = rows[own == c]
            if len(part) <= leaf or len(part) == len(rows):
                nodes[me][1][c] = -1 - leaves
                leaves += 1
            else:
                todo.append((part, me, c))
    return nodes, leaves


def leaf_of(x: np.ndarray, nodes) -> np.ndarray:
    """The leaf each unit vector falls into."""
    at, out = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    open_rows = np.arange(len(x))
    while len(open_rows):
        order = open_rows[np.argsort(at[open_rows], kind="stable")]
        ends = np.flatnonzero(np.diff(at[order])) + 1
        for rows in np.split(order, ends):
            centres, children = nodes[at[rows[0]]]
            own = (x[rows] @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)
            at[rows] = np.array(children)[own]
        done = at[open_rows] < 0
        out[open_rows[done]] = -1 - at[open_rows[done]]
        open_rows = open_rows[~done]
    return out


def visits(q: np.ndarray, nodes, most: int, ids=None, least: int = 0) -> list[int]:
    """Leaves in the order in which best-bin-first opens them: ``most``, and more until they hold ``least`` ids (``ids`` of each leaf)."""
    heap, out, met = [(0.0, 0)], [], 0
    while heap and (len(out) < most or met < least):
        _, node = heapq.heappop(heap)
        if node < 0:
            out.append(-1 - node)
            met += 0 if ids is None else ids[-1 - node]
            continue
        centres, children = nodes[node]
        far = ((centres - q) ** 2).sum(1)
        for d, c in zip(far.tolist(), children, strict=True):
            heapq.heappush(heap, (d, c))
    return out


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the same for a pair wherever it is computed."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def nearest(query_ids, queries: np.ndarray, ids, rows: np.ndarray, k: int = K, leaf=None, visited=None):
    """(query number, row number, score) of each query's k nearest ids, by score and id, each by its nearest row; own rows excluded.

    With ``leaf`` (of each row) and ``visited`` (queries by leaves) a query sees the rows of its visited leaves only.
    """
    if not len(rows) or not len(queries):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    leaf = None if leaf is None else leaf[order]
    scale = lambda x: (x / np.abs(x).max(1, keepdims=True)) / np.sqrt(((x / np.abs(x).max(1, keepdims=True)) ** 2).sum(1, keepdims=True))
    near, left, right, score = scale(rows), [], [], []
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))  # where each id's rows begin
    repeated = len(first) < len(ids)
    for at in range(0, len(queries), 512):
        some = scale(queries[at:at + 512]) @ near.T
        own = query_ids[at:at + 512, None] == ids[None, :]
        if leaf is not None:
            own |= ~visited[at:at + 512][:, leaf]
        some[own] = -np.inf
        for i, s in enumerate(some):
            each = np.maximum.reduceat(s, first) if repeated else s
            keep = min(k, int((each > -np.inf).sum()))
            if keep <= 0:
                continue
            least = np.partition(each, len(each) - keep)[len(each) - keep]
            few = np.flatnonzero(s >= least - 1e-11)
            exact = cosines(np.broadcast_to(queries[at + i], (len(few), queries.shape[1])), rows[few])
            best = np.lexsort((ids[few], -exact))
            if repeated:
                best = best[np.sort(np.unique(ids[few][best], return_index=True)[1])]
            best = best[:keep]
            left.append(np.full(len(best), at + i))
            right.append(order[few[best]])
            score.append(exact[best])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(left), np.concatenate(right), np.concatenate(score)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def calibrate(indexed: DataFrame, queries: DataFrame, nodes, leaves: int, recall: float, k: int, size: int) -> int:
    """Leaf visits that reach ``recall`` on ``size`` queries, against exact neighbours among all rows."""
    few = queries.orderBy(F.xxhash64("query_id"), "query_id", "embedding").limit(size).toArrow()  # bounded
    if not few.num_rows:
        return leaves
    ids, q = few["query_id"].to_numpy(), _matrix(few["embedding"])

    def exact(batches):
        best = []  # the task's own nearest rows so far, query by query
        for batch in batches:
            kept = [pa.Table.from_batches([batch]).select(["vec_id", "leaf", "embedding"])]
            if best:
                kept.append(best[0])
            t = pa.concat_tables(kept).combine_chunks()
            _, rows, _ = nearest(ids, q, t["vec_id"].to_numpy(zero_copy_only=False), _matrix(t["embedding"]), k)
            best = [t.take(pa.array(np.unique(rows)))]
        for t in best:
            a, b, s = nearest(ids, q, t["vec_id"].to_numpy(zero_copy_only=False), _matrix(t["embedding"]), k)
            yield pa.RecordBatch.from_arrays([pa.array(a), t["vec_id"].take(pa.array(b)).combine_chunks(), t["leaf"].take(pa.array(b)).combine_chunks(), pa.array(s)],
                                             ["query_id", "vec_id", "leaf", "score"])

    found = indexed.mapInArrow(exact, "query_id long, vec_id long, leaf int, score double")  # a query is its number here
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.max_by("leaf", "score").alias("leaf"))
    truth = _best(found, k).select("query_id", "leaf").collect()  # size * k rows at most
    place = [{leaf: n for n, leaf in enumerate(visits(v, nodes, leaves))} for v in _unit(q)]
    needed = np.sort([place[r.query_id][r.leaf] + 1 for r in truth])
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) if len(needed) else leaves


def search(vectors: DataFrame, k: int = K, every: int = EVERY, recall: float = TARGET_RECALL, sample: int = SAMPLE,
           leaf_rows: int = LEAF_ROWS, calibration: int = CALIBRATION, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = usable(stored(vectors.select("vec_id", "embedding").filter("vec_id IS NOT NULL").distinct(), "vectors"))
    total = rows.count()
    fitted = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(sample).select("embedding").toArrow()  # bounded
    x = _unit(_matrix(fitted["embedding"])) if fitted.num_rows else np.zeros((0, 1), np.float32)
    nodes, leaves = build(x, max(8, math.ceil(leaf_rows * len(x) / max(1, total))))
    tree = spark.sparkContext.broadcast(nodes)

    def place(batches):
        for batch in batches:
            own = leaf_of(_unit(_matrix(batch.column("embedding"))), tree.value) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(own.astype(np.int32))], ["vec_id", "embedding", "leaf"])

    indexed = materialize(rows.mapInArrow(place, "vec_id long, embedding array<double>, leaf int"))
    queries = indexed.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    most = calibrate(indexed, queries, nodes, leaves, recall, k, calibration)

    sizes = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # a row per leaf, bounded by the sample
    ids_of = [0] * leaves  # an id counts in one of its leaves only, so that no sum is more than there are
    for r in indexed.groupBy("vec_id").agg(F.min("leaf").alias("leaf")).groupBy("leaf").count().collect():
        ids_of[r.leaf] = r["count"]
    place_of, chunks_of, filled = {}, {}, chunk
    for leaf in range(leaves):  # neighbouring leaves follow each other
        n = sizes.get(leaf, 0)
        if filled + n > chunk:
            filled = 0
            chunks_of[len(chunks_of)] = max(1, math.ceil(n / chunk))
        place_of[leaf] = len(chunks_of) - 1
        filled += n

    def walk(batches):
        for batch in batches:
            places, opened, at = [], [], []
            for i, v in enumerate(_unit(_matrix(batch.column("embedding"))) if batch.num_rows else ()):
                mine: dict[int, list[int]] = {}
                for leaf in visits(v, tree.value, most, ids_of, k + 1):
                    mine.setdefault(place_of[leaf], []).append(leaf)
                places += mine.keys()
                opened += mine.values()
                at += [i] * len(mine)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(at), batch.column("embedding").take(at), pa.array(places, pa.int32()),
                                              pa.array(opened, pa.list_(pa.int32()))], ["query_id", "embedding", "place", "leaves"])

    asked = materialize(queries.mapInArrow(walk, "query_id long, embedding array<double>, place int, leaves array<int>"))
    askers = {r.place: r["count"] for r in asked.groupBy("place").count().collect()}  # a row per place
    parts = spark.createDataFrame([(p, n, math.ceil(askers.get(p, 0) / chunk)) for p, n in chunks_of.items()],
                                  "place int, row_chunks int, query_chunks int").filter("query_chunks > 0")
    leaf_places = spark.createDataFrame(list(place_of.items()), "leaf int, place int")
    placed = indexed.join(F.broadcast(leaf_places), "leaf")

    def pairs(df, key: str, own: str, other: str, *more):
        mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int").alias(own[:-1])
        return (df.join(F.broadcast(parts), "place").withColumn("o", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select(key, "embedding", *more, "place", mine, F.col("o").alias(other[:-1])))

    group = ["place", "row_chunk", "query_chunk"]
    left = pairs(placed, "vec_id", "row_chunks", "query_chunks", "leaf")
    right = pairs(asked, "query_id", "query_chunks", "row_chunks", "leaves")

    def score(key, r, q):
        if not r.num_rows or not q.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        own, leaf = np.unique(r["leaf"].to_numpy(), return_inverse=True)
        visited = np.array([np.isin(own, x) for x in q["leaves"].to_pylist()])
        ids, names = q["query_id"].to_numpy(), r["vec_id"].to_numpy()
        a, b, s = nearest(ids, _matrix(q["embedding"]), names, _matrix(r["embedding"]), k, leaf, visited)
        return pa.table({"query_id": pa.array(ids[a]), "vec_id": pa.array(names[b]), "score": pa.array(s)})

    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(score, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
