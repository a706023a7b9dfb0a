import collections

import __spark_entry__
import corpus_pipeline as P
import pytest
from test_chosen_path import plain
from test_line_rules import GOOD
from test_word_bpe import want

from frames import EDGE, SF, documents
from viewlens.llm import fm_quality, line_rules, mixing


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_registered_in_the_order_asked_for():
    assert __spark_entry__.queries()["pipeline"] is P.run
    assert [n for n, _ in P.STAGES] == ["quality classifier", "quality rules", "near duplicates", "mix sources", "encode"]


def test_stages_return_the_columns_of_documents(outputs):
    for df in outputs[:-1]:
        assert df.columns == outputs[0].columns


def test_classifier(spark, outputs):
    docs = outputs[0]
    model = fm_quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(outputs[1]) == ids(fm_quality.score(docs, model).filter("predicted = 1"))
    assert 0 < outputs[1].count() < docs.count()


def test_rules(outputs):
    assert ids(outputs[2]) == ids(line_rules.judge(outputs[1]).filter("kept"))


def test_one_of_each_class(outputs):
    rows = [(r.doc_id, r.text) for r in outputs[2].collect()]
    assert ids(outputs[3]) == sorted({c for _, c, _ in plain(rows)})


def test_mix(outputs):
    want = collections.Counter({r.doc_id: r.repeats for r in mixing.mix(outputs[3]).collect()})
    assert collections.Counter(ids(outputs[4])) == +want


def test_encode(outputs):
    rows = sorted((r.doc_id, r.text) for r in outputs[4].select("doc_id", "text").collect())
    got = sorted((r.doc_id, r.ids, r.decoded) for r in outputs[5].collect())
    assert got == [(i, *want(t)) for i, t in rows]


def test_run_gives_the_last_stage(spark, outputs):
    assert ids(P.run(spark, SF)) == ids(outputs[5])


@pytest.mark.parametrize("rows", ["edge", "none"])
def test_awkward_and_empty_tables(spark, tmp_path, rows):
    """Nulls, empty and long texts, repeated rows, clashing columns, no documents, no labels: every stage returns whole rows."""
    docs = documents(spark, EDGE + [(100 + i, GOOD.replace("word", f"w{chr(97 + i)}")) for i in range(3)] * 2)
    docs = docs if rows == "edge" else docs.limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(100, 1, 0), (3, 0, 0), (None, 1, None), (101, None, 0)], "doc_id long, quality int, toxic int")
    (labels if rows == "edge" else labels.limit(0)).write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for k, (name, stage) in enumerate(P.STAGES[1:-1]):  # what the classifier keeps depends on a handful of labels: all rows go on
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        kept[name] = ids(docs)
    assert kept["near duplicates"] == ([100, 101, 102] if rows == "edge" else [])
    assert set(kept["mix sources"]) <= {100, 101, 102}  # the mix may take a document twice or not at all
    last = P.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in docs.collect())
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} <= {100, 101, 102}
