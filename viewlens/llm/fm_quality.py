"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]): all pairs in linear time by
the sum-of-squares identity. Features are the shares of a document's words (and of their last three characters) by hash
bucket, scaled to unit length, and a few statistics of its structure. The machine is fitted on a bounded sample of labelled
rows, ``sample`` rows by hash of the id, whose features (not texts) come to the driver; scoring is one pass over all
documents with the fixed-size weights in each task.

Defined cases: null and empty texts have all-zero word features and are scored; labels with null id, null quality or
without document are ignored; repeated labels count once each; of documents with equal id the fit sees one (least text hash); without labelled rows every score is 0.5; an empty table
gives an empty result; lang, source, doc_id and labels are no features; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlens.llm.common import coded, fold, hash_words, ship, slices, split_words

ship(__name__)

BUCKETS = 4096
FACTORS = 8
SAMPLE = 6000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
N_STATS = 14
#: Texts are turned into dense rows so many at a time.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 256


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def features(texts: pa.Array, n_chars: np.ndarray) -> np.ndarray:
    """Rows of BUCKETS hashed-word shares and N_STATS statistics (float32)."""
    texts = pc.fill_null(texts, "")
    offsets, words = split_words(texts)
    codes, vocabulary = coded(words)
    n, size = len(texts), np.diff(offsets)
    one = np.maximum(size, 1)
    half = BUCKETS // 2
    bucket = (hash_words(vocabulary) % np.uint64(half)).astype(np.int64)
    ends = (hash_words(pc.utf8_slice_codeunits(vocabulary, -3)) % np.uint64(half)).astype(np.int64) + half
    doc = np.repeat(np.arange(n), size)
    x = np.empty((n, BUCKETS + N_STATS), np.float32)
    for k, b in ((0, bucket), (half, ends - half)):
        cells = np.bincount(doc * half + b[codes], minlength=n * half).reshape(n, half)
        cells = np.log1p(cells)
        x[:, k:k + half] = cells / np.maximum(np.sqrt((cells * cells).sum(1, keepdims=True)), 1e-9)

    def share(pattern: str) -> np.ndarray:
        return _per_doc(pc.count_substring_regex(vocabulary, pattern).to_numpy(zero_copy_only=False)[codes], offsets) / one

    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    distinct = (x[:, :half] > 0).sum(1) / one
    same = np.zeros(len(codes))
    if len(codes) > 1:
        same[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    lines = pc.count_substring(texts, "\n").to_numpy(zero_copy_only=False) + 1
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    stats = [
        np.log1p(size) / 10, distinct, _per_doc(same, offsets) / one, _per_doc(length, offsets) / one / 10,
        _per_doc(length > 20, offsets) / one, np.minimum(share(r"[#*$%&<>]"), 4), np.minimum(share(r"!"), 4), np.minimum(share(r"\|"), 4),
        share(r"^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$"), np.minimum(share(r"[0-9]"), 4), np.minimum(share(r"[.,;:?]"), 4),
        np.minimum(lines / one, 4), np.log1p(chars) / 12, np.log1p(np.maximum(n_chars, 0)) / 12,
    ]
    x[:, BUCKETS:] = np.stack(stats, 1)
    return x


def score_rows(x: np.ndarray, model) -> np.ndarray:
    b, w, v, v2 = model
    mixed = x @ v
    z = b + x @ w + 0.5 * ((mixed * mixed).sum(1) - (x * x) @ v2)
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, factors: int = FACTORS, epochs: int = 20, rate: float = 0.02, l2: float = 1e-4, seed: int = 7):
    """(b, w, v, sum of v^2 by factor) by Adam on the log loss; None without rows."""
    if not len(y):
        return None
    rng = np.random.default_rng(seed)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    p = {"b": np.array([np.log(share / (1 - share))], np.float32), "w": np.zeros(x.shape[1], np.float32),
         "v": (0.01 * rng.standard_normal((x.shape[1], factors))).astype(np.float32)}
    m, s, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 256)):
            a, t = x[rows], y[rows]
            mixed, sq = a @ p["v"], a * a
            z = p["b"] + a @ p["w"] + 0.5 * ((mixed * mixed).sum(1) - sq @ (p["v"] ** 2).sum(1))
            d = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - t) / len(t)).astype(np.float32)
            g = {"b": d.sum(keepdims=True), "w": a.T @ d + l2 * p["w"],
                 "v": a.T @ (d[:, None] * mixed) - (sq.T @ d)[:, None] * p["v"] + l2 * p["v"]}
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return float(p["b"][0]), p["w"], p["v"], (p["v"] ** 2).sum(1)


def _inputs(batch: pa.RecordBatch) -> np.ndarray:
    chars = batch.column(batch.schema.get_field_index("n_chars"))
    return features(batch.column(batch.schema.get_field_index("text")), pc.fill_null(chars, 0).to_numpy(zero_copy_only=False).astype(np.float64))


def _columns(docs: DataFrame):
    return F.col("n_chars").cast("long").alias("n_chars") if "n_chars" in docs.columns else F.lit(0).cast("long").alias("n_chars")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """Fit on ``sample`` labelled rows at most, chosen by hash of the id."""
    chosen = (labels.select("doc_id", F.col("quality").cast("double").alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
              .filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample))
    known = docs.select("doc_id", "text", _columns(docs)).join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    one = known.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "n_chars")).alias("r"))  # reduced in each task first
    rows = one.join(F.broadcast(chosen), "doc_id").select("r.text", "r.n_chars", "y")

    def sparse(batches):
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES, rows=SLICE_ROWS):
                x = _inputs(part)
                out = [(np.flatnonzero(r).astype(np.uint16).tobytes(), r[r != 0].tobytes()) for r in x]
                yield pa.RecordBatch.from_pydict({"y": part.column("y"), "at": pa.array([a for a, _ in out], pa.binary()),
                                                  "x": pa.array([b for _, b in out], pa.binary())})

    got = rows.mapInArrow(sparse, "y double, at binary, x binary").toArrow().sort_by([("at", "ascending"), ("x", "ascending")])
    x = np.zeros((got.num_rows, BUCKETS + N_STATS), np.float32)
    for i, (a, b) in enumerate(zip(got["at"].to_pylist(), got["x"].to_pylist(), strict=True)):
        x[i, np.frombuffer(a, np.uint16)] = np.frombuffer(b, np.float32)
    return fit(x, got["y"].to_numpy().astype(np.float32))


def _scored(texts: pa.RecordBatch, model) -> np.ndarray:
    return np.full(texts.num_rows, 0.5) if model is None else score_rows(_inputs(texts), model)


def score(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", _columns(docs), (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES, rows=SLICE_ROWS):
                s = _scored(part, model)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "score": pa.array(s),
                                                  "predicted": pa.array((s >= threshold).astype(np.int32))})

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents predicted 1, all columns as they were."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES, rows=SLICE_ROWS):
                yield part.filter(pa.array(_scored(part, model) >= threshold))

    if "n_chars" not in docs.columns:
        return keep_good(docs.withColumn("n_chars", F.lit(0).cast("long")), model, threshold).select(*docs.columns)
    return docs.mapInArrow(run, docs.schema)
