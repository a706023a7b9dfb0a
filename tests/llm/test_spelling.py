import random
import re
import zlib
from collections import Counter

import pytest
from frames import SF, documents
from viewlens.llm import spelling
from viewlens.llm.queries import QUERIES


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def deletions(w):
    return {w[:i] + w[i + 1:] for i in range(len(w))}


def plain(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    by = {}
    for w in n:  # words of a common deletion (or one the other's deletion) are the candidates
        for d in deletions(w) | {w}:
            by.setdefault(d, []).append(w)
    nears = {w: set() for w in n}
    for group in by.values():
        for a in group:
            nears[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, others in nears.items():
        best = min(others, key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(nears[w]), n.get(form[w]))
    return out


def found(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(rows)
    assert any(f for f, *_ in want.values())
    assert found(QUERIES["op13_spelling_forms"](spark, SF)) == want


def variants(rng, alphabet="abé", words=60):
    """Texts of words that differ by few edits, so that chains, ties and repeated letters occur."""
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(4, 9))) for _ in range(words)]
    text = []
    for w in base:
        for _ in range(rng.randrange(1, 5)):
            at, c = rng.randrange(len(w) + 1), rng.choice(alphabet + "A")
            text += [rng.choice([w, w[:at] + c + w[at:], w[:at] + w[at + 1:], w[:at] + c + w[at + 1:]])] * rng.randrange(2, 9)
    rng.shuffle(text)
    return [(None if i % 7 == 0 else i, " ".join(text[i::11])) for i in range(11)]


@pytest.mark.parametrize(("seed", "most"), [(1, 20_000), (2, 7), (3, 2), (4, 1)])
def test_brute_force(spark, seed, most):
    rows = variants(random.Random(seed), "ab" if seed == 3 else "abé")
    got = found(spelling.forms(spark.createDataFrame(rows, "doc_id long, text string"), most))
    assert got == plain(rows)


def test_long_shared_beginning_is_cut_to_where_words_part(spark):
    rows = [(1, " ".join(["b" * 300 + w + "c" * 300 for w in ("", "x", "y", "xy", "yx", "xyz")] * 3)), (2, ("A" * 5000 + " ") * 3)]
    assert found(spelling.forms(spark.createDataFrame(rows, "doc_id long, text string"), 2)) == plain(rows)


def test_edges(spark):
    df = documents(spark)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert found(spelling.forms(df)) == plain(rows)
    assert found(spelling.forms(df.unionByName(df))) == plain(rows * 2)
    assert spelling.forms(df.limit(0)).count() == 0


def test_acceptor_is_minimal_and_exact():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(200)})
    arcs, final = spelling.acceptor(words)
    seen, todo = set(), [(0, "")]
    reached = set()
    while todo:
        s, w = todo.pop()
        reached.add(s)
        if final[s]:
            seen.add(w)
        todo += [(to, w + c) for c, to in arcs[s].items()]
    assert seen == set(words)
    assert len({(final[s], *sorted(arcs[s].items())) for s in reached}) == len(reached)  # no two states alike


def test_composition_accepts_each_near_pair_once():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(60)})
    got = [tuple(sorted(p)) for p in spelling.near_pairs(words)]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if a < b and near(a, b)}
