import collections
import random
import re

import pytest
from frames import EDGE, SF, documents, near_copies
from viewlens.llm import chosen_path
from viewlens.llm.components import components


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", text or "") if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain(rows):
    """(class, links) of each row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] is None or rows[j][1] is None:
                continue
            both = len(sets[i] & sets[j])
            if rows[i][1] == rows[j][1] or both and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    names = collections.defaultdict(list)
    for i, (name, _) in enumerate(rows):
        names[find(i)].append(name)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in names.items()}
    return sorted(((rows[i][0], least[find(i)], links[i]) for i in range(len(rows))), key=str)


def got(df, **options):
    return sorted(map(tuple, chosen_path.join(df, **options).collect()), key=str)


def test_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(docs) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(spark):
    assert got(documents(spark)) == plain(EDGE)
    assert got(documents(spark).limit(0)) == []


@pytest.mark.parametrize("chunk", [384, 16])
def test_large_group_is_split_and_loses_no_link(spark, monkeypatch, chunk):
    monkeypatch.setattr(chosen_path, "CHUNK", chunk)
    monkeypatch.setattr(chosen_path, "BUCKET", 12)
    shared = " ".join(f"s{i}" for i in range(40))
    rng = random.Random(3)
    others = [(1000 + i, shared + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(60))) for i in range(60)]
    rows = near_copies(1, 80) + near_copies(2, 5, base=500) + others + [(2000 + i, "the same words over and over") for i in range(30)]
    rows += [(3000 + i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(8))) for i in range(20)]
    assert got(documents(spark, rows)) == plain(rows)


def test_one_document_of_each_class_stays(spark):
    docs = documents(spark)
    kept = chosen_path.representatives(docs)
    assert kept.columns == docs.columns
    want = collections.Counter()
    for i, t in {(i, t) for i, t in EDGE if t is not None}:
        want[i] += 1
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # 1 and the two rows of 6 are equal texts; both null texts stay
    assert ids == sorted([1, 2, 3, 4, None, 5, 7, 8, 9, None, 10, 10], key=str)


def test_runs():
    assert chosen_path.runs_for(0.8, 0.99) < chosen_path.runs_for(0.8, 0.999999) < chosen_path.runs_for(0.6, 0.999999)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(300 + i, 301 + i) for i in range(40)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    nodes = {y for a, b in edges if a != b for y in (a, b)}
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(r.node for r in rows) == sorted(nodes)
    groups = collections.defaultdict(set)
    for r in rows:
        groups[r.root].add(r.node)
    assert all(root in members for root, members in groups.items())
    assert sorted(map(sorted, groups.values())) == sorted(sorted(x for x in nodes if find(x) == r) for r in {find(x) for x in nodes})
