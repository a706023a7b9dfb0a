import random

import numpy as np
import pytest
from frames import EDGE, documents
from viewlens.llm import cross_parse
from viewlens.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_cross_parse_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "n_chars"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.n_chars > 100]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_phrases_against_plain_search(seed):
    rng = random.Random(seed)
    learnt = [rng.randrange(1, 4) for _ in range(400)]
    size, table = cross_parse.automaton(learnt, 6)
    assert size == 400
    said = "".join(map(chr, learnt))
    texts = [[rng.randrange(1, 5) for _ in range(rng.randrange(0, 90))] for _ in range(40)]
    want = []
    for t in texts:  # each piece of a text: phrases are longest matches, an unknown symbol ends one
        total = 0
        for at in range(0, len(t), 32):
            piece, count, now = t[at:at + 32], 1, ""
            for c in piece:
                if now + chr(c) in said:
                    now += chr(c)
                else:
                    count += 1
                    now = chr(c) if chr(c) in said else ""
            total += count
        want.append(total)
    offsets = np.cumsum([0, *map(len, texts)])
    got = cross_parse.phrases(offsets, np.array([c for t in texts for c in t], np.uint8), [(size, table)], 6, segment=32)
    assert got[:, 0].tolist() == want


def test_edges(spark):
    docs = documents(spark)
    model = cross_parse.learn(docs)
    rows = cross_parse.identify(docs, model).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        if r.doc_id in (2, 3, 4):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("und", *model[0]) and 0 <= r.score <= 1
    assert cross_parse.identify(docs.limit(0), model).count() == 0


def test_nothing_learnt_and_one_language(spark):
    none = documents(spark, [(1, "text")]).limit(0)
    model = cross_parse.learn(none)
    assert model[0] == []
    rows = cross_parse.identify(documents(spark, [(1, "some text"), (2, "123")]), model).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    ids = [i for i in range(20) if not __import__("zlib").crc32(str(i).encode()) % 4 == 2][:1]
    one = cross_parse.learn(documents(spark, [(ids[0], "only this language is known")]))
    assert one[0] == ["en"]
    got = cross_parse.predict(["known words", "12 34", None, "ΑΒΓ"], one)
    assert got[0] == ["en", "und", "und", "en"] and got[1].tolist() == [1.0, 0.0, 0.0, 1.0]


@pytest.mark.parametrize("letters", [100, 3000])
def test_many_letters_against_plain_search(letters):
    rng = random.Random(letters)
    learnt = [rng.randrange(1, letters) for _ in range(300)] * 2 + [rng.randrange(1, letters) for _ in range(2400)]
    size, moves = cross_parse.automaton(learnt, letters + 2)
    assert (moves[1] is None) == (letters == 100)
    said = "".join(map(chr, learnt))
    texts = [[rng.randrange(1, letters + 2) for _ in range(9)] + learnt[at:at + 40] for at in range(0, 900, 50)]
    want = []
    for t in texts:
        count, now = 1, ""
        for c in t:
            if now + chr(c) in said:
                now += chr(c)
            else:
                count, now = count + 1, chr(c) if chr(c) in said else ""
        want.append(count)
    offsets = np.cumsum([0, *map(len, texts)])
    got = cross_parse.phrases(offsets, np.array([c for t in texts for c in t], np.uint16), [(size, moves)], letters + 2)
    assert got[:, 0].tolist() == want


def scripts():
    """Languages by their letters: many letters, no spaces, and two that differ in rare letters only."""
    out = {"xa": [chr(0x4E00 + i) for i in range(1200)], "xb": [chr(0x6000 + i) for i in range(1200)], "xc": [chr(0xAC00 + i) for i in range(900)],
           "xd": [chr(0x0E01 + i) for i in range(40)], "xe": [chr(0x0431 + i) for i in range(30)], "xf": [chr(0x03B1 + i) for i in range(15)]}
    return out | {x: list("abcdefgh" * 3 + f"{c}ab{c}cd{c}ef") for x, c in (("xg", "\u014b"), ("xh", "\u0142"))}


def test_every_letter_of_every_script_is_told_apart(spark):
    rng = random.Random(1)
    words = {x: [v[i:i + 3] for i in range(0, len(v), 3)] for x, v in scripts().items()}
    text = lambda x, n=150: "".join(c for _ in range(n) for c in rng.choice(words[x]))
    rows = [(k, text(x), x) for k, x in enumerate(x for x in scripts() for _ in range(30))]
    model = cross_parse.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model[0] == sorted(scripts())
    of = {c: int(model[2][ord(c)]) for _, t, _ in rows for c in t}
    learnt = {c for c, n in of.items() if n != model[3] - 1}
    assert len(learnt) > 2500 and len({of[c] for c in learnt}) == len(learnt)
    said = [(x, text(x)) for x in scripts() for _ in range(5)]
    assert cross_parse.predict([t for _, t in said], model)[0] == [x for x, _ in said]


def test_capitals_follow_their_small_letter():
    table, _ = cross_parse._alphabet({"x": "is \u0131 \u017f \u03c3\u03c2 \u00e4"})
    same = [("I", "i"), ("S", "s"), ("\u03a3", "\u03c3"), ("\u00c4", "\u00e4"), ("\u0130", "i")]
    assert all(table[ord(a)] == table[ord(b)] for a, b in same)
    assert len({int(table[ord(c)]) for c in "is\u0131\u017f\u03c3\u03c2\u00e4"}) == 7
