"""Keyword classification as Spark jobs.

The labelling step works on the *distinct* keywords (not per-user rows,
and with no row cap), produces a keyword dimension ``(keyword, Genre)``
and never passes through the driver. Three labellers:

* ``classify_rules``  -- override table + hint rules as Column
  expressions (JVM-side, the default);
* ``classify_batched`` -- a caller-supplied Python function applied to
  batches of keywords with ``mapInPandas`` (e.g. a client of a model
  service); answers outside the closed label set become "Other";
* ``parse_responses`` -- turns free-text answers containing a JSON object
  into per-keyword labels.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.functions import classify_rules as CR
from viewlens.session import stored
from viewlens.sources.publish import exists

# Worker code travels by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LABELS = "keyword string, Genre string"
Labeller = Callable[[list[str]], Mapping[str, str] | Sequence[str]]


def distinct_keywords(df: DataFrame, col: str = "keyword") -> DataFrame:
    return df.select(F.col(col).alias("keyword")).filter(F.col("keyword").isNotNull()).distinct()


def _one_label(table: DataFrame) -> DataFrame:
    """One label per keyword (the least), NULL keywords dropped."""
    return (table.filter(F.col("keyword").isNotNull())
            .groupBy("keyword").agg(F.min("Genre").alias("_override")))


def with_overrides(labels: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """Labels replaced by those of an override table where it has the keyword."""
    if overrides is None:
        return labels
    return (labels.join(_one_label(overrides), "keyword", "left")
            .select("keyword", CR.closed_genre(F.coalesce("_override", "Genre")).alias("Genre")))


def _with_names(kw: DataFrame, names: DataFrame | None) -> DataFrame:
    """Adds ``_named``: the genre of a keyword that is, without case, a name of the table (countries, clubs, events)."""
    if names is None:
        return kw.withColumn("_named", F.lit(None).cast("string"))
    table = (names.filter(F.col("name").isNotNull()).groupBy(F.lower("name").alias("_name"))
             .agg(F.min("Genre").alias("_named")))
    return kw.join(table, F.lower("keyword") == F.col("_name"), "left").select("keyword", "_named")


def classify_rules(keywords: DataFrame, overrides: DataFrame | None = None, names: DataFrame | None = None) -> DataFrame:
    """(keyword, Genre) for the distinct keywords.

    Order: ``overrides`` (keyword, Genre) table, worked examples, word hints,
    ``names`` (name, Genre) lookup, default. Tables are joined by key (the
    optimizer broadcasts one only when its runtime size is under the
    broadcast threshold).
    """
    kw = _with_names(distinct_keywords(keywords), names)
    return with_overrides(kw.select("keyword", CR.rule_genre(F.col("keyword"), F.col("_named")).alias("Genre")), overrides)


def rule_hints(keywords: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(keyword, Hint): the hint rules alone, NULL where none applies."""
    return _with_names(distinct_keywords(keywords), names).select(
        "keyword", F.coalesce(CR.hint_genre(F.col("keyword")), F.col("_named")).alias("Hint"))


def _batches(it: Iterable[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for pdf in it:
        for start in range(0, len(pdf), size):
            yield pdf.iloc[start:start + size]


def classify_batched(keywords: DataFrame, labeller: Labeller, batch_size: int = 100,
                     num_partitions: int | None = None, genres: Sequence[str] = S.GENRES,
                     default: str = S.DEFAULT_GENRE, on_failure: str = "default", failures=None) -> DataFrame:
    """Apply ``labeller`` to batches of at most ``batch_size`` distinct keywords.

    The labeller gets a list of keywords and returns either a mapping
    keyword -> label or a list of labels in the same order. A failing call
    labels its batch with the default (``on_failure="default"``, as the
    reference does on errors) or leaves its keywords out (``"omit"``), so
    that a later run can ask for them again. ``failures``: an accumulator
    that gets the number of keywords whose call failed.

    Calls run in ``num_partitions`` tasks (default: the cluster's
    parallelism), a fixed number that adaptive execution does not merge.
    """
    if on_failure not in ("default", "omit"):
        raise ValueError("on_failure must be 'default' or 'omit'")
    kw = distinct_keywords(keywords)
    kw = kw.repartition(num_partitions or kw.sparkSession.sparkContext.defaultParallelism, "keyword")
    allowed = set(genres)

    def run(it):
        for batch in _batches(it, batch_size):
            words = batch["keyword"].astype(str).tolist()
            try:
                labels = _closed(labeller(words), words, allowed, default)
            except Exception:  # noqa: BLE001 - one bad batch must not fail the job; it is counted
                if failures is not None:
                    failures.add(len(words))
                if on_failure == "omit":
                    continue
                labels = [default] * len(words)
            yield pd.DataFrame({"keyword": words, "Genre": labels})

    return kw.mapInPandas(run, "keyword string, Genre string")


def classify_resumable(keywords: DataFrame, labeller: Labeller, ledger: str, batch_size: int = 100, genres: Sequence[str] = S.GENRES,
                       default: str = S.DEFAULT_GENRE, batches_per_job: int = 10_000) -> DataFrame:
    """(keyword, Genre) of the distinct keywords, by a labeller that may die and is then asked only for what it has not answered.

    ``ledger``: a Parquet folder of answers. Every batch is a task of its own, and its answers are in the ledger as soon as the task
    ends (each task commits its own file), whatever becomes of the job. The next run, or a task that is tried again, asks for the
    keywords that the ledger lacks. A labeller's error is not caught: it fails the task and, after Spark's retries, the run. Should a
    task be lost after its file was committed, its keywords may be in the ledger twice: they count once, with the least label.
    """
    spark, ask = keywords.sparkSession, distinct_keywords(keywords)
    todo = stored(_unanswered(ask, ledger).withColumn("i", F.monotonically_increasing_id()), "to-label")
    # dense numbers, from the totals of the stored partitions: batch b has the keywords b * size to (b + 1) * size - 1
    part, place = F.shiftright("i", 33), F.col("i").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r.p: r.n for r in todo.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, n = [], 0
    for p in sorted(sizes):
        starts.append((p, n))
        n += sizes[p]
    if n:
        start = F.broadcast(spark.createDataFrame(starts, "p long, start long"))  # a row per partition
        numbered = stored(todo.withColumn("p", part).join(start, "p").select("keyword", F.floor((F.col("start") + place) / batch_size).alias("batch")), "batches")
    for first in range(0, -(-n // batch_size), batches_per_job):
        count = min(batches_per_job, -(-n // batch_size) - first)
        job = numbered.filter((F.col("batch") >= first) & (F.col("batch") < first + count))
        job = job.withColumn("batch", (F.col("batch") - first).cast("int")).repartitionById(count, "batch").select("keyword")
        (job.mapInPandas(_answers(labeller, set(genres), default), "keyword string, Genre string").write.mode("append")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger))  # a task's file is there when the task ends
    return answered(spark, ledger).join(ask, "keyword", "left_semi")


def answered(spark: SparkSession, ledger: str) -> DataFrame:
    """(keyword, Genre) of a ledger, one row per keyword."""
    if not exists(spark, ledger):
        return spark.createDataFrame([], _LABELS)
    return spark.read.schema(_LABELS).parquet(ledger).groupBy("keyword").agg(F.min("Genre").alias("Genre"))


def _unanswered(ask: DataFrame, ledger: str) -> DataFrame:
    return ask.join(answered(ask.sparkSession, ledger).select("keyword"), "keyword", "left_anti")


def _answers(labeller: Labeller, allowed: set[str], default: str):
    def run(it):
        frames = list(it)  # one batch
        words = [w for f in frames for w in f["keyword"].astype(str)]
        if words:
            yield pd.DataFrame({"keyword": words, "Genre": _closed(labeller(words), words, allowed, default)})
    return run


def _closed(answer, words: list[str], allowed: set[str], default: str) -> list[str]:
    """A labeller's answer as labels of the closed set, one for each word."""
    labels = [answer.get(w, default) for w in words] if hasattr(answer, "get") else list(answer)
    if len(labels) != len(words):
        raise ValueError("labeller returned a wrong number of labels")
    return [x if isinstance(x, str) and x in allowed else default for x in labels]


def rules_labeller(overrides: Mapping[str, str] = S.GENRE_EXAMPLES,
                   hints: Sequence[tuple[str, Sequence[str]]] = S.GENRE_HINTS) -> Labeller:
    """A Python labeller with the same rules as ``classify_rules``."""
    overrides, default = dict(overrides), S.DEFAULT_GENRE
    hints = [(genre, [w.lower() for w in words]) for genre, words in hints]

    def label(words):
        return [overrides.get(w) or next((genre for genre, ws in hints if any(x in w.lower() for x in ws)), default)
                for w in words]
    return label


def parse_responses(responses: DataFrame, text_col: str = "response", keywords_col: str = "keywords") -> DataFrame:
    """(response text, keywords asked) rows -> (keyword, Genre) rows.

    The JSON object is the span from the first '{' to the last '}'; a
    missing object, malformed JSON or a missing key gives "Other".
    """
    parsed = responses.select(CR.parse_response_map(F.col(text_col)).alias("_m"),
                              F.explode(F.col(keywords_col)).alias("keyword"))
    return parsed.select("keyword", CR.closed_genre(CR.label_from_response(F.col("_m"), F.col("keyword")))
                         .alias("Genre"))


def classify_incremental(keywords: DataFrame, known: DataFrame, labeller: Labeller | None = None,
                         batch_size: int = 100, num_partitions: int | None = None,
                         overrides: DataFrame | None = None, names: DataFrame | None = None, failures=None) -> DataFrame:
    """Labels for all distinct keywords, calling the labeller only for new ones.

    ``known``: an existing (keyword, Genre) table (for example last run's
    output). Keywords already in it keep their label; the rest (a left-anti
    join, so only the new keywords are shuffled against the table) go
    through the labeller -- or the rules when none is given. Returns known
    and new labels together, one row per keyword; keywords whose labeller
    call failed are left out, so the next run asks for them again.
    """
    kw = distinct_keywords(keywords)
    known = (known.filter(F.col("keyword").isNotNull())
             .groupBy("keyword").agg(F.min("Genre").alias("Genre")))  # one label per keyword, deterministic
    fresh = kw.join(known.select("keyword"), "keyword", "left_anti")
    if labeller:
        labelled = with_overrides(classify_batched(fresh, labeller, batch_size, num_partitions, on_failure="omit",
                                                   failures=failures), overrides)
    else:
        labelled = classify_rules(fresh, overrides, names)
    return known.join(kw, "keyword", "left_semi").unionByName(labelled)
