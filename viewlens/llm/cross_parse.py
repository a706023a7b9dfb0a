"""Language identification by cross-parsing entropy.

A bounded sample of labelled texts per language is indexed by a suffix automaton. A text is parsed greedily against each
language: a phrase is the longest match of what follows in that language's text. The count of phrases, times the logarithm of the
language's indexed length, over the text's length estimates the cross entropy; the least wins. Automata are transition
tables of bounded size sent to every task: flat over the language's own letters, or sorted (state, letter) pairs where these
are many. Texts are cut into segments that are parsed in step, all of them to their end (a phrase ends where a segment ends).
Letters are compared without case; every letter of a sample is told apart, whatever the script; runs of other characters are
one space.

The sample: for each language the ``rows`` training rows first by hash of the id among those of ``row_chars`` code points at most (only
if there are none, longer ones cut to that length), up to ``chars`` code points in all.

Defined cases: null texts and texts without letters are ``und`` with score 0; ties go to the first language in code point
order; without learned languages all is ``und``; one learned language scores 1; null and repeated ids are rows like others; an empty
table gives an empty result; lang, source and doc_id are not used for a prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewlens.llm.common import fold, ship, slices

ship(__name__)

FOLDS, HELD_OUT = 4, 2
ROWS, ROW_CHARS, CHARS = 40, 6000, 30000
SEGMENT = 512
#: An automaton of more letters is kept as sorted pairs, not as a flat table; the result is the same.
FLAT = 128
SPACE = 0


def automaton(text: list[int], width: int) -> tuple[int, tuple]:
    """(length, moves) of the suffix automaton of integers under ``width``; state 0 is none, 1 the root.

    Moves are (own, pairs, to): own letter of each class (0 where the automaton has none), sorted state * letters + letter or
    None, and the state that each pair, or each place of a flat table, leads to.
    """
    step, link, length = [{}, {}], [0, 0], [0, 0]
    last = 1
    for c in text:
        now = len(step)
        step.append({})
        link.append(1)
        length.append(length[last] + 1)
        p = last
        while p and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    own = np.zeros(width, np.int32)
    held = sorted(step[1])
    own[held] = np.arange(1, len(held) + 1)
    letters = len(held) + 1
    small = np.uint16 if len(step) < 1 << 16 else np.uint32
    pairs = np.array([s * letters + int(own[c]) for s, moves in enumerate(step) for c in moves], np.int64)
    to = np.array([t for moves in step for t in moves.values()], small)
    if letters > FLAT:
        order = np.argsort(pairs)
        return max(2, len(text)), (own, pairs[order], to[order])
    table = np.zeros(len(step) * letters, small)
    table[pairs] = to
    return max(2, len(text)), (own, None, table)


def _fold(c: str) -> str:
    return c.lower()[0]


def _alphabet(samples: dict[str, str]) -> tuple[np.ndarray, int]:
    """(class of every code point, number of classes): 0 no letter, then each letter of the samples, last the letters of none."""
    seen = sorted({_fold(c) for c in set("".join(samples.values())) if c.isalpha()})
    number = {c: i + 1 for i, c in enumerate(seen)}
    table = np.full(0x110000, SPACE, np.uint16 if len(seen) + 2 <= 1 << 16 else np.uint32)
    for i in range(0x110000):
        if not 0xD800 <= i < 0xE000 and chr(i).isalpha():
            table[i] = number.get(_fold(chr(i)), len(seen) + 1)
    return table, len(seen) + 2


def classes_of(texts: list[str], table: np.ndarray):
    """(offsets, classes): each text's classes with runs of spaces merged."""
    size = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    c = table[points]
    owner = np.repeat(np.arange(len(texts)), size)
    keep = np.ones(len(c), bool)
    if len(c) > 1:
        keep[1:] = (c[1:] != SPACE) | (c[:-1] != SPACE) | (owner[1:] != owner[:-1])
    return np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(texts)))]), c[keep]


def learn(docs: DataFrame, rows: int = ROWS, row_chars: int = ROW_CHARS, chars: int = CHARS):
    """(languages, automata, class table, classes) from a bounded sample of the training rows."""
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    picked = (known.select("lang", F.length("text").alias("n"), F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"), "doc_id")
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n") > row_chars, "h", "doc_id", "t")))
              .filter(F.col("rank") <= rows).select("lang", "doc_id", "t", "rank"))
    texts = (known.select("lang", "doc_id", F.xxhash64("text").alias("t"), F.substring("text", 1, row_chars).alias("text"))
             .join(F.broadcast(picked.withColumnsRenamed({"doc_id": "pid", "lang": "plang", "t": "pt"})),
                   F.col("doc_id").eqNullSafe(F.col("pid")) & (F.col("t") == F.col("pt")) & (F.col("lang") == F.col("plang")))
             .select("lang", "rank", "text").distinct().collect())
    samples: dict[str, str] = {}
    for r in sorted(texts, key=lambda r: (r.lang, r["rank"], r.text)):
        if len(samples.get(r.lang, "")) < chars:
            samples[r.lang] = (samples.get(r.lang, "") + " " + r.text)[:chars]
    table, width = _alphabet(samples)
    languages = [x for x in sorted(samples) if any(c.isalpha() for c in samples[x])]
    automata = [automaton(classes_of([samples[x]], table)[1].tolist(), width) for x in languages]
    return languages, automata, table, width


def _step(moves: tuple, state: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The states that classes ``c`` lead to, 0 where there is no such move."""
    own, pairs, to = moves
    letter = own[c]
    letters = int(own.max(initial=0)) + 1
    if pairs is None:
        return to[state * letters + letter].astype(np.int64)
    out = np.zeros(len(c), np.int64)
    known = np.flatnonzero(letter)  # only these can move
    want = state[known] * letters + letter[known]
    at = np.minimum(np.searchsorted(pairs, want), len(pairs) - 1)
    out[known] = np.where(pairs[at] == want, to[at], 0)
    return out


def phrases(offsets: np.ndarray, classes: np.ndarray, automata: list, width: int, segment: int = SEGMENT) -> np.ndarray:
    """Phrases of each text (rows) in each language (columns)."""
    n = np.diff(offsets)
    pieces = -(-n // segment)
    owner = np.repeat(np.arange(len(n)), pieces)
    first = np.concatenate([[0], np.cumsum(pieces)])[:-1]
    start = np.repeat(offsets[:-1], pieces) + (np.arange(len(owner)) - np.repeat(first, pieces)) * segment
    size = np.minimum(start + segment, np.repeat(offsets[1:], pieces)) - start
    order = np.argsort(-size, kind="stable")
    owner, start, size = owner[order], start[order], size[order]
    active = np.searchsorted(-size, -np.arange(segment), side="left")  # segments longer than k
    out = np.zeros((len(n), len(automata)))
    state = [np.ones(len(owner), np.int64) for _ in automata]
    count = [np.ones(len(owner), np.int32) for _ in automata]
    everything = np.arange(width)
    roots = [_step(moves, np.ones(width, np.int64), everything) for _, moves in automata]
    for k in range(int(size[0]) if len(size) else 0):
        m = int(active[k])
        c = classes[start[:m] + k].astype(np.int64)
        for (_, moves), s, cnt, root in zip(automata, state, count, roots, strict=True):
            to = _step(moves, s[:m], c)
            stop = to == 0
            cnt[:m] += stop
            again = np.maximum(root[c], 1)
            s[:m] = np.where(stop, again, to)
    for i, cnt in enumerate(count):
        out[:, i] = np.bincount(owner, weights=cnt, minlength=len(n))
    return out


def predict(texts: list, model):
    """(language or und, score) of each text."""
    languages, automata, table, width = model
    offsets, classes = classes_of([t or "" for t in texts], table)
    letters = np.concatenate([[0], np.cumsum(classes != SPACE)])[offsets]
    none = np.diff(letters) == 0
    if not languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    cost = phrases(offsets, classes, automata, width) * np.array([np.log2(n) for n, _ in automata])
    best = cost.argmin(1)
    low = cost.min(1)
    if len(languages) == 1:
        score = np.ones(len(texts))
    else:
        second = np.partition(cost, 1, axis=1)[:, 1]
        score = second / np.maximum(low + second, 1e-12)
    return [("und" if no else languages[b]) for no, b in zip(none.tolist(), best.tolist(), strict=True)], np.where(none, 0.0, score)


def identify(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, lang_pred, score: a row per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: languages x chars

    def run(batches):
        for batch in batches:
            for part in slices(batch, limit=4 << 20):
                lang, score = predict(part.column("text").to_pylist(), shared.value)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                                                  "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())})

    rows = docs.select("doc_id", "text", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
