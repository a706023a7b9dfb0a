"""Embedding whitening with Spark MLlib's distributed block matrices.

Every component becomes the integer ``floor(1024 * c) + 100000``. One aggregate gives the number of rows and the exact sum of each
dimension. Rows are centred, exactly up to one division, indexed 0, 1, 2 ... by the totals of their stored partitions, and put into a
BlockMatrix of bounded blocks. Its transpose times itself is the scatter matrix; the middle dimension is cut into many parts, so no task
meets more than a few blocks. The eigenvectors of the scatter, a matrix of dimensions by dimensions, are found on the driver; the block
matrix times the whitening matrix projects the rows.

Every covariance has divisor n and is made of centred values. An eigenvector's largest entry (the first of equals) is positive.

Defined cases: rows whose vector is null or empty or holds null or non-finite entries are dropped, and rows whose vector has another
length than the commonest one of the rest (the least of equals); every other row counts, repeated rows and null ids too; with fewer than
``components`` dimensions there are so many components; a component along which the rows do not vary (a share of the variance below
1e-11) has null ``whitened``, explained 0, and no part in ``identity_error``, which is null if there is no other; a ``deviation`` or a
component that does not fit a long raises; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlens.session import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries of a block: at least so many, and more only to keep the number of blocks below MOST_BLOCKS (their coordinates reach the driver).
BLOCK_ENTRIES = 1 << 16
MOST_BLOCKS = 1 << 16
#: Entries that a task of the transpose multiplication meets on either side.
TASK_ENTRIES = 1 << 20
NO_VARIANCE = 1e-11
LONG = 1 << 63


def scaled(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, x (array of long): the rows that take part."""
    c = F.col("embedding").cast("array<double>")
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = vectors.select("vec_id", F.when(~bad, c).alias("c")).filter(F.col("c").isNotNull() & (F.size("c") > 0))
    common = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), "d").first()  # one row
    rows = rows.filter(F.size("c") == F.lit(common.d if common else 0))
    whole = F.transform("c", lambda v: F.floor(v * scale).cast("decimal(38,0)") + shift)
    fits = F.forall(whole, lambda v: F.abs(v) < F.lit(1 << 62).cast("decimal(38,0)"))
    x = F.when(fits, F.transform("c", lambda v: F.floor(v * scale) + shift)).otherwise(F.raise_error(F.lit("a component does not fit a long")))
    return rows.select("vec_id", x.alias("x"))


def indexed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``idx`` 0, 1, 2 ...: places in the stored partitions, moved by the totals of those before (a number a partition)."""
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stored(rows.select(F.spark_partition_id().alias("p"), own.alias("i"), *rows.columns), "whitening-rows")
    totals = rows.groupBy("p").agg((F.max("i") + 1).alias("n")).orderBy("p").collect()
    first = np.concatenate([[0], np.cumsum([t.n for t in totals])])
    starts = rows.sparkSession.createDataFrame([(t.p, int(n)) for t, n in zip(totals, first[:-1], strict=True)], "p int, start long")
    return rows.join(F.broadcast(starts), "p").select((F.col("start") + F.col("i")).alias("idx"), *[c for c in rows.columns if c not in ("p", "i")])


def sums(rows: DataFrame) -> tuple[int, list[int], bool]:
    """Number of rows, the exact sum of each dimension, and whether all of (n * x - S)^2 add up in longs: a row per dimension
    reaches the driver."""
    each = (rows.select(F.posexplode("x").alias("d", "x")).groupBy("d")
            .agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.min("x").alias("low"), F.max("x").alias("high"))
            .orderBy("d").collect())
    n = each[0].n if each else 0
    most = [max(abs(n * r.low - int(r.s)), abs(n * r.high - int(r.s))) for r in each]
    reach = max((n * max(abs(r.low), abs(r.high)) for r in each), default=0)
    return n, [int(r.s) for r in each], sum(m * m for m in most) < LONG and reach < LONG


def off_mean(n: int, s: list[int], kind: str) -> Column:
    """n * x - S, exact."""
    total = F.array(*[F.lit(str(v)).cast(kind) for v in s])
    return F.zip_with("x", total, lambda x, v: (x.cast(kind) * F.lit(str(n)).cast(kind) - v).cast(kind))


def deviation(off: Column, kind: str) -> Column:
    """The sum of squares as a long."""
    square = F.aggregate(off, F.lit("0").cast(kind), lambda a, v: (a + v * v).cast(kind))
    if kind == "long":
        return square
    return F.when(square < F.lit(str(LONG)).cast(kind), square.try_cast("long")).otherwise(F.raise_error(F.lit("deviation does not fit a long")).cast("long"))


def block_matrix(rows: DataFrame, n: int, d: int) -> BlockMatrix:
    """idx, y (array of double) as a BlockMatrix; rows stay in the JVM."""
    high = max(1, BLOCK_ENTRIES // d, math.ceil(n / MOST_BLOCKS))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("idx", array_to_vector("y").alias("y")), "y")
    blocks = IndexedRowMatrix(vectors, n, d).toBlockMatrix(high, d)
    blocks.persist(StorageLevel.MEMORY_AND_DISK)  # two multiplications read them; lost ones are made again from the stored rows
    return blocks


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix: dimensions by dimensions, summed over parts of the middle dimension."""
    d, high = blocks.numCols(), blocks.rowsPerBlock
    parts = max(1, math.ceil(blocks.numRows() * d / max(TASK_ENTRIES, high * d)))
    product = blocks.transpose()._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(product, d, d).toLocalMatrix().toArray()


def eigen(v: np.ndarray, components: int):
    """Eigenvalues, falling, and unit eigenvectors in columns, the largest entry of each positive."""
    e, u = np.linalg.eigh((v + v.T) / 2)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return e, u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)


def projected(blocks: BlockMatrix, by: np.ndarray) -> DataFrame:
    """idx, z: the rows of the matrix times ``by``."""
    block = Matrices.dense(*by.shape, by.ravel(order="F").tolist())
    right = BlockMatrix(blocks._java_matrix_wrapper._sc.parallelize([((0, 0), block)], 1), *by.shape)
    product = blocks.multiply(right).toIndexedRowMatrix()
    z = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return z.select(F.col("index").alias("idx"), vector_to_array("vector").alias("z"))


def identity_error(z: DataFrame, n: int, k: int) -> float | None:
    """Largest absolute entry of the covariance of the first k entries of z, centred, minus the identity."""
    if not k:
        return None
    at = [F.col("z")[j] for j in range(k)]
    mean = z.agg(*[(F.sum(c) / n).alias(f"m{j}") for j, c in enumerate(at)]).first()
    entries = [(i, j) for i in range(k) for j in range(i + 1)]
    cov = z.agg(*[(F.sum((at[i] - mean[i]) * (at[j] - mean[j])) / n).alias(f"c{i}_{j}") for i, j in entries]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(entries, cov, strict=True))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per remaining row and component."""
    rows = indexed(scaled(vectors))
    n, s, narrow = sums(rows)
    if not n:
        return rows.select("vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
                           *[F.lit(None).cast("double").alias(c) for c in ("whitened", "explained", "identity_error")]).filter(F.lit(False))
    kind = "long" if narrow else "decimal(38,0)"  # decimals where a long could overflow
    off = off_mean(n, s, kind)
    blocks = block_matrix(rows.select("idx", F.transform(off, lambda v: v.cast("double") / n).alias("y")), n, len(s))
    v = scatter(blocks) / n
    e, u = eigen(v, components)
    trace = float(np.trace(v))
    some = e > NO_VARIANCE * trace
    k = int(some.sum())
    z = stored(projected(blocks, u[:, :k] / np.sqrt(e[:k])), "whitening-projected") if k else None
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    error = identity_error(z, n, k) if k else None
    out = rows.select("idx", "vec_id", deviation(off, kind).alias("deviation"))
    out = out.join(z, "idx") if k else out.withColumn("z", F.array().cast("array<double>"))
    each = [F.struct(F.lit(j + 1).alias("component"), F.get("z", F.lit(j)).alias("whitened"),
                     F.lit(float(e[j] / trace) if j < k else 0.0).alias("explained")) for j in range(len(e))]
    return (out.select("vec_id", "deviation", F.explode(F.array(*each)).alias("c"))
            .select("vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
                    F.lit(error).cast("double").alias("identity_error")))
