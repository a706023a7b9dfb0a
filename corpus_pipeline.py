"""Corpus pipeline over ``documents``: classify, clean, drop near copies, mix sources, encode.

Every stage takes (spark, docs, sf_dir), works on all rows the stage before it kept, and returns a DataFrame that is written as
Parquet and read again. All but the last return the columns of ``documents``.

Defined cases: null and empty texts, and texts under 50 words, go with the quality rules; of equal and near rows one stays; null ids
are kept; columns besides doc_id, text and source pass through the stages unread (``n_chars`` follows a cleaned text) and end with the
last one; without documents, or if nothing is kept, the result is empty; without labels every score is 0.5 and no document stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from viewlens.llm import chosen_path, fm_quality, line_rules, mixing, word_bpe
from viewlens.llm.common import documents
from viewlens.llm.queries import word_vocabulary
from viewlens.session import scratch_path


def quality_classifier(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores 0.7 or more stay."""
    return fm_quality.keep_good(docs, fm_quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def quality_rules(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that fail the base check or lose too much go."""
    return line_rules.clean(docs)


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts linked at 0.8 or more stays."""
    return chosen_path.representatives(docs)


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target mix takes them."""
    return mixing.mixed(docs)


def encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded of every document."""
    return word_bpe.encode(docs, word_vocabulary())


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("mix sources", mix_sources),
    ("encode", encode),
]

#: A trained classifier decides the first stage, which SQL cannot say; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
