import pytest
from frames import EDGE, SF, documents
from viewlens.checks.compare import compare_one, duck
from viewlens.llm import mixing
from viewlens.llm.queries import QUERIES, SQL


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > most * sizes[s]}
        if not full:
            return target | {s: level * w[s] for s in free}
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def test_sql(spark):
    r = compare_one(spark, duck(SF), "op1", QUERIES["op1_mix_sources"], SQL["op1_mix_sources"], SF)
    assert r["ok"], r


@pytest.mark.parametrize("few", [10_000, 0])
def test_targets_and_budget(spark, few):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs, broadcast=few).collect()
    sizes, taken, longest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    want = plain_targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s, t in taken.items():
        assert want[s] - longest[s] <= t <= want[s] + 1e-6
    again = mixing.mix(docs, broadcast=0 if few else 10_000).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_edges(spark):
    docs = documents(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(EDGE)
    assert all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (2, 3, 4))
    twins = [r.repeats for r in rows if r.doc_id == 6]
    assert len(twins) == 2
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.repeats for r in rows)
    assert all(r.repeats == 0 for r in rows if r.size == 0)
    assert out.filter("text IS NULL OR NOT text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'").count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_no_words_at_all(spark):
    rows = mixing.mix(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r.target, r.taken) for r in rows] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("share", [1.5, 0.4])
def test_texts_without_ids_are_told_apart(spark, share):
    """A source of null ids, and one of a single id, come within one document of their targets."""
    rows = [(None, "w " * (1 + i % 7) + f"n{i}", "null ids") for i in range(300)] + [(5, "w " * (1 + i % 5) + f"e{i}", "one id") for i in range(200)]
    rows += [(i, f"a b c d {i}", "ids") for i in range(100)] + [(None, None, "null ids"), (5, "", "one id")]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=share).collect()
    for source in ("null ids", "one id", "ids"):
        mine = [r for r in out if r.source == source]
        assert mine[0].target - max(r.size for r in mine) <= sum(r.taken for r in mine) <= mine[0].target + 1e-6
        assert all(r.repeats == 0 for r in mine if r.size == 0)
