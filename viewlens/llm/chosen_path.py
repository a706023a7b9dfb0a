"""N-gram Jaccard join by chosen paths.

Texts are sets of 5-word shingles. Each distinct text gets a sketch of 64 minima. A run starts at two sketch coordinates;
texts with the same minimum there share a path. Small path groups are compared in full; a larger one is split again at two
coordinates drawn from its path, and so on. A pair at the threshold survives a run with a known probability, so runs are
repeated until the target recall. A group that splitting does not thin out (a child with half its parent's texts) or that is still
large at the last level is held together as a whole. Pairs within reach by their sketches tie texts into candidate groups;
in these every pair is then checked exactly on whole shingle sets, large groups in chunk pairs over many tasks. No pair is
written: tasks return each text's number of links and one edge per text to the least text it is linked with.

Equal texts are one text with a weight, so copies cost a row each. A link joins two documents whose similarity is the
threshold or more; equal texts are linked. Classes are connected components of links.

Defined cases: a text of 1 to 4 words is one shingle; a text without words links to equal texts only; a null text is a class of
its own without links; repeated rows are copies; a class is named by its least non-null doc_id; an empty table gives an empty
result; other columns are ignored. Shingles and texts are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewlens.llm.common import coded, hash_words, mix64, ship, slices, split_words
from viewlens.llm.components import components
from viewlens.session import materialize, stored

ship(__name__)

WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999999
COORDINATES = 64
BRANCHES = 2
#: Path groups up to this many texts are compared in full.
BUCKET = 96
DEPTH = 6
#: Exact comparison works on chunks of so many texts.
CHUNK = 384


def runs_for(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``, also if every level is used."""
    meet = 1.0
    for _ in range(depth):
        meet = 1 - (1 - threshold * meet) ** BRANCHES
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def shingle_hashes(offsets: np.ndarray, words: np.ndarray, size: int = WORDS):
    """(offsets, hashes) of the shingles of each row's word hashes, repeats included."""
    n = np.diff(offsets)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    starts = np.concatenate([[0], np.cumsum(count)])
    place = np.repeat(offsets[:-1] - starts[:-1], count) + np.arange(starts[-1])
    short = np.repeat(n, count) < size
    last = np.repeat(offsets[1:], count) - 1
    h = np.full(len(place), 0x51ED270B, np.uint64)
    for k in range(size):
        at = place + k
        there = at <= last
        w = words[np.minimum(at, last)] if len(words) else np.zeros(0, np.uint64)
        h = np.where(there | ~short, mix64(h * np.uint64(0x9E3779B97F4A7C15) + w), h)
    return starts, h


def minima(starts: np.ndarray, hashes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Rows of 32-bit minima; rows without shingles are left at zero."""
    rows = np.flatnonzero(np.diff(starts))
    out = np.zeros((len(starts) - 1, coordinates), np.uint32)
    if not len(rows):
        return out
    factors = mix64(np.arange(coordinates), 11) | np.uint64(1)
    heads = starts[rows]
    for k in range(coordinates):
        out[rows, k] = np.minimum.reduceat(hashes * factors[k], heads) >> np.uint64(32)
    return out


def _text_shingles(texts: pa.Array):
    offsets, words = split_words(texts)
    codes, vocabulary = coded(words)
    h = hash_words(vocabulary)
    return shingle_hashes(offsets, h[codes] if len(codes) else np.zeros(0, np.uint64))


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _matrix(column, kind, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def text_key(text=None):
    return F.md5(F.coalesce(text if text is not None else F.col("text"), F.lit("")).cast("binary"))


def sketched(docs: DataFrame) -> DataFrame:
    """key, tid, rep, copies, sketch, small: a row per distinct text that has words; ``small`` has 8 bits a coordinate."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                starts, h = _text_shingles(part.column("text"))
                m = minima(starts, h)
                rows = pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), _binary(m), _binary(m.astype(np.uint8))],
                                                  ["doc_id", "key", "sketch", "small"])
                yield rows.filter(pa.array(np.diff(starts) > 0))

    rows = docs.filter("text IS NOT NULL").select("doc_id", "text", text_key().alias("key"))
    rows = rows.mapInArrow(run, f"doc_id {kind}, key string, sketch binary, small binary")
    return rows.groupBy("key").agg(F.xxhash64("key").alias("tid"), F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
                                   F.first("sketch").alias("sketch"), F.first("small").alias("small"))


def _roots(runs: int):
    def run(batches):
        for batch in batches:
            m, tid, small = _matrix(batch.column("sketch"), np.uint32, COORDINATES), batch.column("tid"), batch.column("small")
            for r in range(runs):
                for b in range(BRANCHES):
                    c = (r * BRANCHES + b) % COORDINATES
                    path = mix64(mix64(m[:, c].astype(np.uint64), c), r)
                    yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), tid, small, pa.nulls(len(tid), pa.int64())], ["path", "tid", "small", "parent"])
    return run


def _children(batches):
    for batch in batches:
        m, tid = _matrix(batch.column("sketch"), np.uint32, COORDINATES), batch.column("tid")
        path = batch.column("path").to_numpy().view(np.uint64)
        first = (mix64(path, 3) % np.uint64(COORDINATES)).astype(np.int64)
        second = (first + 1 + (mix64(path, 4) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
        for c in (first, second):
            child = mix64(path ^ mix64(m[np.arange(len(c)), c].astype(np.uint64) * np.uint64(COORDINATES) + c.astype(np.uint64), 5), 6)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), tid, batch.column("small"), batch.column("size")], ["path", "tid", "small", "parent"])


def _find(parent: list, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _least_linked(n: int, a, b, names: np.ndarray):
    """(rows, names): for each row tied to another, the least name of its component."""
    parent = list(range(n))
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        i, j = _find(parent, i), _find(parent, j)
        if i != j:
            parent[max(i, j)] = min(i, j)
    rows = np.unique(np.concatenate([a, b])) if len(a) else np.zeros(0, np.int64)
    root = np.array([_find(parent, i) for i in rows.tolist()], np.int64)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, root, names[rows])
    return rows, least[root]


def _whole_groups(batches, column: str):
    """Tables that end where a group of the sorted column ends."""
    kept = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        kept = t if kept is None else pa.concat_tables([kept, t])
        keys = kept[column].to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if len(keys) and (keys != keys[-1]).any() else 0
        if cut:
            yield kept.slice(0, cut).combine_chunks()
            kept = kept.slice(cut).combine_chunks()
    if kept is not None and kept.num_rows:
        yield kept.combine_chunks()


def _compare(least: float):
    """From rows of small groups sorted by path: one edge a text to the least text tied to it in its group.

    A text is tied to another of the group if their sketches agree enough.
    """
    def run(batches):
        for t in _whole_groups((b for b in batches if b.num_rows), "path"):
            path, tid = t["path"].to_numpy(), t["tid"].to_numpy()
            m = _matrix(t["small"], np.uint8, COORDINATES)
            a, b, step = [], [], 1
            rows = np.arange(len(path) - 1)
            while len(rows):
                rows = rows[rows + step < len(path)]
                rows = rows[path[rows] == path[rows + step]]
                near = rows[(m[rows] == m[rows + step]).mean(1) >= least] if len(rows) else rows
                a.append(near)
                b.append(near + step)
                step += 1
            if a:
                rows, roots = _least_linked(len(path), np.concatenate(a), np.concatenate(b), tid)
                yield pa.RecordBatch.from_arrays([pa.array(tid[rows]), pa.array(roots)], ["u", "v"])
    return run


def candidate_edges(texts: DataFrame, runs: int, threshold: float) -> DataFrame:
    """u, v: edges whose components hold every pair that met on a path within reach of the threshold.

    Each level first counts the paths, narrow and combined before the shuffle. Rows of large groups stay where they are: they are
    met with their group's size and least text by a join that sends the few large paths to the tasks, and go to the next level or,
    where their group is dense, get an edge to its least text. Only rows of groups of 2 to BUCKET are shuffled by path and compared.
    """
    least = threshold - 4.5 * math.sqrt(threshold * (1 - threshold) / COORDINATES)
    schema = "path long, tid long, small binary, parent long"
    rows, edges = texts.select("sketch", "small", "tid").mapInArrow(_roots(runs), schema), []
    for level in range(DEPTH):
        if level:
            rows = stored(rows, "paths")
        large = rows.groupBy("path").agg(F.count("*").alias("size"), F.min("tid").alias("least")).filter(F.col("size") > BUCKET)
        large = stored(large, "large-paths")
        small = rows.join(large.select("path"), "path", "left_anti").select("path", "tid", "small")
        small = small.withColumn("size", F.count("*").over(Window.partitionBy("path"))).filter("size > 1").drop("size")
        edges.append(stored(small.sortWithinPartitions("path").mapInArrow(_compare(least), "u long, v long"), "path-edges"))
        if large.isEmpty():
            break
        met = rows.select("path", "tid", "parent").join(large, "path")
        dense = F.lit(level == DEPTH - 1) | F.coalesce(2 * F.col("size") >= F.col("parent"), F.lit(False))
        met = stored(met.select("path", "tid", "size", "least", dense.alias("dense")), "large-groups")
        edges.append(met.filter("dense AND tid != least").select(F.col("tid").alias("u"), F.col("least").alias("v")))
        rows = met.filter("NOT dense").select("path", "tid", "size").join(texts.select("tid", "sketch", "small"), "tid").mapInArrow(_children, schema)
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def _shingle_sets(batches):
    for batch in batches:
        for part in slices(batch):
            starts, h = _text_shingles(part.column("text"))
            sets = [np.unique(h[a:b]).tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("grp"), part.column("tid"), part.column("copies"), part.column("chunks"),
                                              pa.array(sets, pa.binary())], ["grp", "tid", "copies", "chunks", "sh"])


def _common(left: list, right: list, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, by blocks of shingles that occur on both sides."""
    la, lb = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float64)
    sides = []
    for values, sizes in ((a, la), (b, lb)):
        at = np.searchsorted(shared, values)
        here = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == values) if len(shared) else np.zeros(len(values), bool)
        owner, at = np.repeat(np.arange(len(sizes)), sizes)[here], at[here]
        order = np.argsort(at, kind="stable")
        sides.append((owner[order], at[order]))
    for start in range(0, len(shared), width):
        x = []
        for (owner, at), n in zip(sides, (len(left), len(right)), strict=True):
            lo, hi = np.searchsorted(at, (start, start + width))
            d = np.zeros((n, min(width, len(shared) - start)), np.float32)
            d[owner[lo:hi], at[lo:hi] - start] = 1
            x.append(d)
        out += x[0] @ x[1].T
    return out


def _verify(threshold: float):
    """Exact links of one chunk pair: each text's weight of linked texts, and the least text it is tied to here."""
    def run(key, t):
        i, j = key[1].as_py(), key[2].as_py()
        t = t.sort_by([("chunk", "ascending"), ("tid", "ascending")])
        tid, copies, chunk = t["tid"].to_numpy(), t["copies"].to_numpy(), t["chunk"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in t["sh"].to_pylist()]
        n = np.array([len(x) for x in sets], np.float64)
        rows, cols = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        links = np.zeros(len(tid), np.int64)
        a = b = np.zeros(0, np.int64)
        if len(rows) and len(cols):
            common = _common([sets[r] for r in rows], [sets[c] for c in cols])
            near = common >= threshold * (n[rows][:, None] + n[cols][None, :] - common) - 1e-9
            if i == j:
                np.fill_diagonal(near, False)
                links[rows] = near @ copies[cols]
                near = np.triu(near)
            else:
                links[rows] = near @ copies[cols]
                links[cols] = near.T @ copies[rows]
            x, y = np.nonzero(near)
            a, b = rows[x], cols[y]
        tied, least = _least_linked(len(tid), a, b, tid)
        to = tid.copy()
        to[tied] = least
        return pa.table({"grp": t["grp"], "tid": pa.array(tid), "links": pa.array(links), "least": pa.array(to), "chunks": t["chunks"]})
    return run


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """key, rep, class_id, n_links, first: a row per distinct text; ``first`` is the one text that stands for its class."""
    texts = materialize(sketched(docs))
    met = components(candidate_edges(texts, runs_for(threshold, recall), threshold))
    sizes = met.groupBy("root").agg(F.count("*").alias("n"))
    groups = met.join(sizes, "root").select(F.col("root").alias("grp"), F.col("node").alias("tid"),
                                            F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    groups = groups.join(texts.select("tid", "key", "rep", "copies"), "tid")

    first = docs.filter("text IS NOT NULL").select(F.col("doc_id").alias("id"), text_key().alias("own"), "text")
    chosen = first.join(groups, (F.col("own") == F.col("key")) & F.col("id").eqNullSafe(F.col("rep"))).select("text", "grp", "tid", "copies", "chunks")
    sets = chosen.mapInArrow(_shingle_sets, "grp long, tid long, copies long, chunks int, sh binary").dropDuplicates(["tid"])
    chunk = F.pmod(F.xxhash64("tid"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    pairs = (sets.withColumn("chunk", chunk).withColumn("other", other)
             .withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}))
    checked = materialize(pairs.groupBy("grp", "i", "j").applyInArrow(
        _verify(threshold), "grp long, tid long, links long, least long, chunks int"))

    alone = F.when(F.col("chunks") == 1, F.col("least"))
    known = (texts.select("key", "tid", "rep", "copies")
             .join(checked.groupBy("tid").agg(F.sum("links").alias("links"), F.min(alone).alias("alone")), "tid", "left"))
    tied = components(checked.filter("chunks > 1 AND least != tid").select(F.col("tid").alias("u"), F.col("least").alias("v")))
    known = known.join(tied, F.col("tid") == F.col("node"), "left").select(
        "key", F.coalesce("alone", "root", "tid").alias("root"), "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    order = F.struct(F.col("rep").isNull().alias("unnamed"), "rep", "key")
    names = known.groupBy("root").agg(F.min(order).alias("least"))
    known = known.join(names, "root").select("key", "rep", F.col("least.rep").alias("class_id"), "n_links",
                                             (F.col("key") == F.col("least.key")).alias("first"))
    wordless = docs.filter(F.col("text").isNotNull() & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", text_key().alias("key"))
    blank = wordless.groupBy("key").agg(F.min("doc_id").alias("rep"), F.min("doc_id").alias("class_id"), (F.count("*") - 1).alias("n_links"))
    return known.unionByName(blank.withColumn("first", F.lit(True)))


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """doc_id, class_id, n_links: a row per document."""
    known = classes(docs, threshold, recall).select("key", "class_id", "n_links")
    rows = docs.select("doc_id", F.when(F.col("text").isNotNull(), text_key()).alias("key"))
    return rows.join(known, "key", "left").select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def representatives(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """One document of each class, all columns as they were; null texts all stay."""
    first = classes(docs, threshold, recall).filter("first").select(F.col("key").alias("first_key"), F.col("rep").alias("first_id"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"),
                       F.when(F.col("text").isNotNull(), text_key()).alias("own_key"))
    kept = rows.join(first, (F.col("own_key") == F.col("first_key")) & F.col("own_id").eqNullSafe(F.col("first_id")), "left_semi")
    return kept.dropDuplicates(["own_key", "own_id"]).unionByName(rows.filter("own_key IS NULL")).select("row.*")
