"""Mixing sources to target weights by nested hash thresholds (built-in functions only).

Each source gets a token budget. ``full`` whole passes take every document, and the rest of the budget takes the
documents whose hash lies below a threshold. The threshold is found without sorting documents: tokens are summed
by source and hash bucket, the bucket in which the budget ends is refined by the next bits, and so on until the
hash is exhausted. What a long document at the threshold leaves over is filled by further rounds over the shorter
documents that still fit.

Defined cases: a null text has size 0, and a document of size 0 is never taken; a null source is a source of its own, last in
order; a document's hash is that of its id and text (null: empty), so different texts with null or equal ids are told apart, and
only rows equal in both are taken together or not at all; sources without words get target 0; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlens.llm.common import word_count
from viewlens.session import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
HASH_BITS = 60
#: Bits by which each refinement splits the boundary bucket; they add up to HASH_BITS. The last one meets one of 2^18 buckets of a
#: source, a few thousand documents of a billion.
LEVELS = (18, 42)
ROUNDS = 3
SALTS = 32
#: So many sources are broadcast at most (a row each).
BROADCAST_SOURCES = 10_000
_END = 1 << HASH_BITS


def hash60(doc_id: Column, text: Column) -> Column:
    """The first 15 hex digits of the MD5 of id, line feed, text, as a number."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, h: one narrow row per document, written once for all passes."""
    return stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              hash60(F.col("doc_id"), F.col("text")).alias("h")), "mix-sizes")


def source_targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target, full, budget: a row per source.

    Water filling: a source's target is min(most * size, level * weight), the level such that all targets add up to
    share * total. That is where resharing the excess of full sources by weight ends. The windows run over sources.
    """
    by_source = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(by_source) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = (rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", w)
         .withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight")))
    before = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("level", (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    s = s.withColumn("level", F.min_by(F.when(F.col("ratio") >= F.col("level"), F.col("level")),
                                       F.when(F.col("ratio") >= F.col("level"), F.col("ratio"))).over(everything))
    s = s.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double"))))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return s.select("source", "source_size", "target", full.alias("full"),
                    (F.col("target") - full * F.col("source_size")).alias("left"))


def _with(rows: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """Rows with their source's state. ``few`` sources are broadcast; else a source is joined in SALTS parts by hash."""
    state = state.withColumnRenamed("source", "state_source")
    same = F.col("source").eqNullSafe(F.col("state_source"))
    if few:
        return rows.join(F.broadcast(state), same).drop("state_source")
    state = state.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(state, same & (F.pmod("h", F.lit(SALTS)).cast("int") == F.col("salt"))).drop("state_source", "salt")


def _threshold(candidates: DataFrame, state: DataFrame, name: str, few: bool) -> DataFrame:
    """state plus ``name``: the least hash at which a source's candidates exceed ``left``; ``left`` less what lies below."""
    done = 0
    state = state.withColumns({"prefix": F.lit(0).cast("long"), "base": F.lit(0).cast("long")})
    for bits in LEVELS:
        done += bits
        rest = HASH_BITS - done
        keys = state.select("source", F.col("prefix").alias("at"), F.col("base").alias("from"), F.col("left").alias("most"))
        hist = (_with(candidates, keys, few).filter(F.shiftright("h", rest + bits) == F.col("at"))
                .groupBy("source", F.shiftright("h", rest).alias("bucket"), "from", "most").agg(F.sum("size").alias("size")))
        up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        over = F.col("cum") > F.col("most")
        found = (hist.withColumn("cum", F.col("from") + F.sum("size").over(up_to)).groupBy("source")
                 .agg(F.min(F.when(over, F.col("bucket"))).alias("next"), F.max(F.when(~over, F.col("cum"))).alias("below"))
                 .withColumnRenamed("source", "found_source"))
        state = (state.join(found, F.col("source").eqNullSafe(F.col("found_source")), "left").drop("found_source")
                 .withColumns({"prefix": F.col("next"), "base": F.coalesce("below", "base")}).drop("next", "below"))
    return (state.withColumns({name: F.coalesce("prefix", F.lit(_END)), f"{name}_left": F.col("left"),
                               "left": F.col("left") - F.col("base")}).drop("prefix", "base"))


def _taken(rounds: int) -> Column:
    """Whether the rounds so far take a document once more."""
    hits = [(F.col("h") < F.col(f"t{k}")) & (F.col("size") <= F.col(f"t{k}_left")) for k in range(rounds)]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def decisions(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, rounds: int = ROUNDS, broadcast: int = BROADCAST_SOURCES):
    """(state, few): a row per source with its target, whole passes and thresholds; whether there are few enough to broadcast."""
    state = stored(source_targets(rows, weights, share, most), "mix-state")
    few = state.count() <= broadcast
    for k in range(rounds):
        tried = [x for j in range(k) for x in (f"t{j}", f"t{j}_left")]
        known = _with(rows, state.select("source", F.col("left").alias("fits"), *tried), few)
        open_rows = known.filter(~_taken(k) & (F.col("size") <= F.col("fits"))).select("source", "size", "h")
        state = stored(_threshold(open_rows, state, f"t{k}", few), "mix-state")
    return state, few


def _repeats(rounds: int) -> Column:
    return F.when(F.col("size") > 0, F.col("full") + F.when(_taken(rounds), 1).otherwise(0)).otherwise(0)


def mix(docs: DataFrame, rounds: int = ROUNDS, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats, taken: a row per document, ``taken = repeats * size``."""
    rows = sized(docs)
    state, few = decisions(rows, rounds=rounds, **options)
    out = _with(rows, state, few).withColumn("repeats", _repeats(rounds))
    return out.select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, rounds: int = ROUNDS, **options) -> DataFrame:
    """The documents the mix takes, each as often as it is taken, all columns as they were."""
    state, few = decisions(sized(docs), rounds=rounds, **options)
    row = F.struct(*[F.col(c) for c in docs.columns])
    rows = docs.select(row.alias("row"), "source", word_count(F.col("text")).alias("size"), hash60(F.col("doc_id"), F.col("text")).alias("h"))
    return _with(rows, state, few).select("row", F.explode(F.array_repeat(F.lit(1), _repeats(rounds).cast("int")))).select("row.*")
