"""Verdicts, lost words and cleaned texts of the line rules against a plain reading of them, text by text."""

import collections
import functools
import random
import re

import pyarrow as pa
import pytest
from frames import EDGE, SF, documents
from test_line_rules import plain
from viewlens.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PHRASE = re.compile(line_rules.BOILERPLATE)


def normal(line):
    return " ".join(WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in line)))


@functools.cache
def sign(line):
    """The least hash of a line's 3-word windows; only the hash of one window is the library's."""
    words = line.split(" ")
    windows = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    return int(line_rules.least_windows(pa.array(windows)).min())


def plain_common(texts):
    """Lines that 30 or more, and a thousandth, of the texts hold, at least half of them beside other least windows."""
    held, beside = collections.Counter(), collections.defaultdict(set)
    for text in texts:
        own = {normal(line) for line in (text or "").split("\n")} - {""}
        for line in own:
            held[line] += 1
            beside[line].add(min((sign(other) for other in own - {line}), default=0))
    return {x for x, n in held.items() if n >= max(30, len(texts) / 1000) and 2 * len(beside[x]) >= n and len(x.split(" ")) <= 40}


def plain_verdict(text, common):
    """kept, lost words, cleaned text."""
    text, seen, left, lost = text or "", set(), [], 0
    for line in text.split("\n"):
        words = len(WORD.findall(line))
        marks, separators = len(re.findall(r"[#*$%&|<>!~^=@{}\\]", line)), len(re.findall("[|»›·•]", line))
        bad = words >= 3 and marks > 0.3 * words
        bad |= words >= 60 and not re.search("[.!?,;:…。！？]", line)
        bad |= separators >= 3 and words <= 4 * (separators + 1)
        bad |= words > 0 and (PHRASE.search(line) is not None or line in seen)
        bad |= 0 < words <= 40 and normal(line) in common
        seen.add(line)
        lost += words if bad else 0
        left += [] if bad else [line]
    n, failed = plain(text)[0], plain(text)[-1]
    return not failed and lost <= 0.5 * n, lost, "\n".join(left)


def corpus(seed):
    """Texts of own sentences mixed with lines of every rule, at its bounds too, and with lines that few, many or only copies share."""
    rng = random.Random(seed)
    odd = ["All rights reserved.", "Log in", "log in now", "Home | News | Sport | About", "a | b | c", " | ".join(["five words of a part"] * 4),
           "a## b c", "a# b c d", "a#! b c d e", " ".join(f"r{i}" for i in range(59)), " ".join(f"r{i}" for i in range(60)),
           " ".join(f"r{i}" for i in range(60)) + " end…", "", "   ", "x", "© someone 2020", "\x0bshare this now", "twice", "twice", "  twice"]
    rows = []
    for i in range(150):
        lines = [" ".join(f"w{seed}x{i}x{j}x{k}" for k in range(rng.randrange(5, 15))) + "." for j in range(rng.randrange(1, 16))]
        lines += rng.choices(odd, k=rng.randrange(12))
        if i < 40:
            lines.append(rng.choice(["Join OUR  newsletter today", "join our newsletter\ttoday"]))
        if 20 <= i < 49:
            lines.append("twenty-nine texts hold this")
        if i >= 100:
            lines.append(" ".join(["many"] + [f"m{k}" for k in range(rng.choice([39, 40]))]) + ",")
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    copy = "\n".join([" ".join(f"copy{j}x{k}" for k in range(12)) + "." for j in range(8)])
    return rows + [(1000 + i, copy) for i in range(45)] + EDGE


def check(docs, rows):
    common = plain_common([t for _, t in rows])
    want = [(i, *plain_verdict(t, common)) for i, t in rows]
    got = [(r.doc_id, r.kept, r.lost_words) for r in line_rules.judge(docs).collect()]
    assert sorted(got, key=str) == sorted(((i, kept, lost) for i, kept, lost, _ in want), key=str)
    cleaned = [(r.doc_id, r.text) for r in line_rules.clean(docs).collect()]
    assert sorted(cleaned, key=str) == sorted(((i, text) for i, kept, _, text in want if kept), key=str)
    return common, want


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rows = corpus(seed)
    common, want = check(documents(spark, rows).repartition(5), rows)
    assert "join our newsletter today" in common and "twenty-nine texts hold this" not in common
    assert not any(x.startswith("copy") for x in common)
    assert len({kept for _, kept, _, _ in want}) == 2


def test_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])
