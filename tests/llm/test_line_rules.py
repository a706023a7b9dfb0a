import collections
import random
import re

from frames import EDGE, SF, documents
from viewlens.llm import line_rules
from viewlens.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def columns(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_tables(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op6_line_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert columns(r) == plain(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_edges(spark):
    rows = line_rules.judge(documents(spark)).collect()
    key = lambda x: (str(x[0]), x[1:])
    assert sorted(((r.doc_id, *columns(r)) for r in rows), key=key) == sorted(((i, *plain(t)) for i, t in EDGE), key=key)
    assert line_rules.judge(documents(spark).limit(0)).count() == 0
    assert line_rules.clean(documents(spark).limit(0)).count() == 0


SENTENCES = [" ".join(f"word{i}x{j}" for j in range(14)) + "." for i in range(8)]
GOOD = "\n".join(SENTENCES)


def test_lines(spark):
    rows = [(1, GOOD), (2, GOOD + "\nAll rights reserved.\nHome | News | Sport | About\nlast line stays."),
            (3, GOOD + "\n" + SENTENCES[0]), (4, "\n".join(f"a{i} | b{i} | c{i} | d{i} | e{i}" for i in range(30))),
            (5, "\n".join(f"x{i}### y{i}*** z{i}%%% w{i}" for i in range(40))), (6, "\n\n" + GOOD + "\n\n"),
            (7, " ".join(f"run{i}" for i in range(80))), (8, SENTENCES[0])]
    docs = documents(spark, rows)
    kept = {r.doc_id: r for r in line_rules.clean(docs).collect()}
    assert sorted(kept) == [1, 2, 3, 6]
    assert kept[1].text == GOOD and kept[6].text == "\n\n" + GOOD + "\n\n"
    assert kept[2].text == GOOD + "\nlast line stays."
    assert kept[3].text == GOOD and kept[3].n_chars == len(GOOD)
    assert line_rules.clean(docs).columns == docs.columns


def test_labels(spark):
    """Held against the quality labels: junk goes, good documents of 50 words stay."""
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op6_line_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.995 * len(good) and sum(bad) <= 0.05 * len(bad)


def held_lines(text):
    """Normalised line -> the 3-word windows of the document's other lines."""
    lines = {}
    for line in text.split("\n"):
        words = [w.translate({65 + i: 97 + i for i in range(26)}) for w in WORD.findall(line)]
        if words:
            lines.setdefault(" ".join(words), {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))})
    return {k: set().union(*(w for o, w in lines.items() if o != k)) for k in lines}


def test_common_lines(spark):
    """Lines of many different documents go, whatever their language; those of copies and long passages stay."""
    def own(i):
        rng = random.Random(i)
        return "\n".join(" ".join(f"own{rng.randrange(10**8)}" for _ in range(10)) + "." for _ in range(16))

    passage = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)) + "."
    rows = [(i, own(i) + f"\n{"Mentions" if i % 2 else "mentions"} LÉGALES   du site\n" + passage) for i in range(60)] + [(100 + i, GOOD + f"\nchanged line number {chr(97 + i % 26)}{i // 26 * 'z'}.") for i in range(80)]
    docs = documents(spark, rows)
    assert len(line_rules.common_lines(docs, least=50)) == 1
    kept = {r.doc_id: r.text for r in line_rules.clean(docs).collect()}
    assert len(kept) == 140
    assert all(kept[i] == own(i) + "\n" + passage for i in range(60))
    assert all(kept[i] == rows[i - 40][1] for i in range(100, 180))
    assert len(line_rules.common_lines(docs, least=61)) == 0 and len(line_rules.common_lines(docs.limit(0))) == 0


def test_near_copies_are_no_boilerplate(spark):
    """A family of near copies, each with some words changed anywhere: none of its lines is dropped."""
    rng = random.Random(4)
    base = [[f"word{rng.randrange(10**6)}" for _ in range(12)] for _ in range(15)]
    texts = []
    for _ in range(400):
        own = [list(line) for line in base]
        for _ in range(5):
            own[rng.randrange(15)][rng.randrange(12)] = f"new{rng.randrange(10**9)}"
        texts.append("\n".join(" ".join(line) + "." for line in own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(line_rules.common_lines(docs)) == 0
    assert line_rules.clean(docs).count() == 400


def test_counts_against_a_plain_version(spark):
    """Lines by what their documents hold besides: windows hashed by the operator's function, the rest counted plainly."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in docs.collect() if r.text]

    def least(windows):
        return int(line_rules.least_windows(line_rules.pa.array([" ".join(w) for w in sorted(windows)])).min()) if windows else 0

    held = collections.defaultdict(list)
    for t in texts:
        for k, windows in held_lines(t).items():
            if len(k.split(" ")) <= line_rules.LINE_WORDS:
                held[k].append(frozenset(windows))
    often = {k: v for k, v in held.items() if len(v) >= 3}
    want = {k for k, v in often.items() if 2 * len({least(w) for w in v}) >= len(v)}
    names = sorted(often)
    got = set(line_rules.common_lines(docs, share=0, least=3).tolist())
    assert {k for k, h in zip(names, line_rules.line_hashes(line_rules.pa.array(names)).tolist(), strict=True) if h in got} == want and len(got) == len(want)
