"""Line-first cleaning: drop failing lines, then reject documents that lose too much text.

A line (texts are split at line feeds) fails by the first rule that holds:
- punctuation: more than ``symbols_per_word`` marks of ``#*$%&|<>!~^=@{}\\`` a word (3 words at least), or
  ``run_on_words`` words without any sentence punctuation;
- navigation: three separators at least, with no more than ``nav_words`` words between two of them;
- boilerplate: the line stands in many documents of the corpus (below); the whole line is a licence, rights, cookie, login or
  share phrase; or it repeats an earlier line of the document.
A document is rejected if its base check fails, or if failing lines held more than ``most_lost`` of its words.

Lines are counted over the whole corpus, without case (A-Z) and spacing: a line of at most LINE_WORDS words is boilerplate if
COMMON_SHARE of the documents hold it (LEAST_COMMON at least) and these are different documents, not copies of each other: the least
hash of the 3-word windows of their other lines, which near copies mostly share, takes half as many values at least. Counting is two narrow aggregates of 16-byte rows, combined before the shuffle. There are
at most 1 / COMMON_SHARE times as many such lines as a document has lines on average, so their hashes are sent to every task. The
rules are then one pass over Arrow batches, cut into slices of bounded bytes.

Defined cases: null and empty texts have no words, fail the base check and stay empty; lines without words are kept and count nothing;
repeated rows and ties are judged alike; an empty table gives an empty result; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlens.llm.common import WORD, coded, hash_words, mix64, ship, slices, split_words

ship(__name__)

SYMBOLS_PER_WORD = 0.3
RUN_ON_WORDS = 60
NAV_WORDS = 4
MOST_LOST = 0.5
COMMON_SHARE, LEAST_COMMON = 0.001, 30
LINE_WORDS = 40
#: Fixed patterns of whole boilerplate lines.
BOILERPLATE = (
    r"(?i)^\s*(all rights reserved\.?|(copyright|\(c\)|©).{0,80}|(licensed|released|distributed) under (the )?.{2,60}"
    r"|this work is licensed under .{2,80}|(we|this (web)?site) uses? cookies.{0,120}|accept (all )?cookies\.?|(log|sign) (in|up|out)\.?"
    r"|subscribe( now)?( to our newsletter)?\.?|share (this|on) .{0,30}|(read|see|show) more\.?|(terms of (use|service)|privacy policy)\.?"
    r"|click here.{0,40}|skip to (main )?content\.?|back to top\.?|powered by .{1,30})\s*$"
)
_SEPARATOR = r"[|»›·•]"


def _repeated(offsets: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
    """Per document: words inside 3-word windows that occur twice or more in it."""
    out = np.zeros(len(offsets) - 1, np.int64)
    n = len(codes)
    if n < 3:
        return out
    if size < 1 << 21:
        tri = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    else:  # too many distinct words for three codes in 63 bits
        pair = np.unique(codes[:-1] * size + codes[1:], return_inverse=True)[1].astype(np.int64)
        tri = pair[:-1] * size + codes[2:]
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if b - a < 4:
            continue
        own = tri[a:b - 2]
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        if not same.any():
            continue
        hit = np.zeros(len(own), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        cover = np.zeros(b - a, bool)
        for k in range(3):
            cover[k:k + len(own)] |= hit
        out[i] = cover.sum()
    return out


def _lines(texts: pa.Array):
    """(lines, offsets, document of each line) of texts without nulls."""
    lists = pc.split_pattern(texts, "\n")
    lines, at = lists.values, lists.offsets.to_numpy().astype(np.int64)
    lines, at = lines.slice(at[0], at[-1] - at[0]), at - at[0]
    return lines, at, np.repeat(np.arange(len(texts)), np.diff(at))


def line_hashes(distinct: pa.Array) -> np.ndarray:
    """Hashes of lines that do not see case (A-Z) and spacing."""
    return hash_words(pc.ascii_trim_whitespace(pc.replace_substring_regex(pc.ascii_lower(distinct), r"[\x20\x09-\x0D]+", " ")))


def least_windows(distinct: pa.Array) -> np.ndarray:
    """The least hash of each line's 3-word windows (a shorter line is one window; without words: the largest number)."""
    offsets, words = split_words(distinct, lower=True)
    codes, vocabulary = coded(words)
    h, n = hash_words(vocabulary)[codes], np.diff(offsets)
    out = np.full(len(n), np.iinfo(np.uint64).max, np.uint64)
    window = h.copy()
    for k in (1, 2):  # the next words of the same line
        line = np.repeat(np.arange(len(n)), n)
        inside = np.flatnonzero(line[:-k] == line[k:]) if len(h) > k else np.zeros(0, np.int64)
        window[inside] = mix64(window[inside], k) + h[inside + k]
    place = np.arange(len(h)) - np.repeat(offsets[:-1], n)
    whole = place <= np.maximum(np.repeat(n, n) - 3, 0)
    some = np.flatnonzero(n > 0)
    if len(some):
        window[~whole] = np.iinfo(np.uint64).max
        out[some] = np.minimum.reduceat(window, offsets[:-1][some])
    return out


def _held_lines(batches):
    """For each document and each of its lines, once: the line's hash, and the document's sign without the line (0: there is nothing else)."""
    for batch in batches:
        for part in slices(batch):
            lines, _, doc = _lines(pc.fill_null(part.column("text"), ""))
            code, distinct = coded(lines)
            words = _count(distinct, WORD)
            h, least = line_hashes(distinct), least_windows(distinct)
            some = np.flatnonzero(words[code] > 0) if len(code) else np.zeros(0, np.int64)
            order = some[np.lexsort((h[code[some]], doc[some]))]
            again = np.zeros(len(order), bool)
            again[1:] = (doc[order[1:]] == doc[order[:-1]]) & (h[code[order[1:]]] == h[code[order[:-1]]])
            order = order[~again]
            order = order[np.lexsort((least[code[order]], doc[order]))]
            d, hashes, least = doc[order], h[code[order]], least[code[order]]
            sign = np.zeros(len(d), np.uint64)
            if len(d):
                first = np.searchsorted(d, d)  # the line with the document's least window, and the next one
                second = np.minimum(first + 1, len(d) - 1)
                sign = np.where(np.arange(len(d)) == first, np.where(d[second] == d, least[second], np.uint64(0)), least[first])
            short = words[code[order]] <= LINE_WORDS
            yield pa.RecordBatch.from_arrays([pa.array(hashes[short].view(np.int64)), pa.array(sign[short].view(np.int64))], ["line", "sign"])


def common_lines(docs: DataFrame, share: float = COMMON_SHARE, least: int = LEAST_COMMON) -> np.ndarray:
    """Ascending hashes of the corpus's boilerplate lines."""
    enough = max(least, math.ceil(share * docs.count()))
    held = docs.select("text").mapInArrow(_held_lines, "line long, sign long")
    by_sign = held.groupBy("line", "sign").agg(F.count("*").alias("n"))
    lines = by_sign.groupBy("line").agg(F.sum("n").alias("n"), F.count("*").alias("different"))
    found = lines.filter((F.col("n") >= enough) & (2 * F.col("different") >= F.col("n"))).select("line").collect()
    return np.sort(np.array([r.line for r in found], np.int64).view(np.uint64))


def _count(a: pa.Array, pattern: str) -> np.ndarray:
    return pc.count_substring_regex(a, pattern).to_numpy(zero_copy_only=False).astype(np.int64)


def _sum_rows(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def measure(texts: pa.Array, symbols_per_word=SYMBOLS_PER_WORD, run_on=RUN_ON_WORDS, nav_words=NAV_WORDS, most_lost=MOST_LOST,
            common: np.ndarray | None = None):
    """(columns, cleaned texts) of a slice of texts; ``common``: what ``common_lines`` found."""
    texts = pc.fill_null(texts, "")
    offsets, words = split_words(texts)
    codes, vocabulary = coded(words)
    n_words = np.diff(offsets)
    word_chars = _sum_rows(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64), offsets)

    lines, at, doc = _lines(texts)
    in_line = _count(lines, WORD)
    line_code, distinct = coded(lines)
    order = np.lexsort((np.arange(len(lines)), line_code, doc))
    later = np.zeros(len(lines), bool)
    later[order[1:]] = (line_code[order[1:]] == line_code[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    later &= in_line > 0

    def per_line(pattern: str) -> np.ndarray:  # each distinct line is looked at once
        return _count(distinct, pattern)[line_code] if len(lines) else np.zeros(0, np.int64)

    marks = per_line(r"[#*$%&|<>!~^=@{}\\]")
    bad = (in_line >= 3) & (marks > symbols_per_word * in_line)
    bad |= (in_line >= run_on) & (per_line(r"[.!?,;:…。！？]") == 0)
    separators = per_line(_SEPARATOR)
    bad |= (separators >= 3) & (in_line <= nav_words * (separators + 1))
    bad |= (per_line(BOILERPLATE) > 0) & (in_line > 0)
    if common is not None and len(common) and len(lines):
        bad |= np.isin(line_hashes(distinct), common)[line_code] & (in_line > 0) & (in_line <= LINE_WORDS)
    bad |= later
    lost = _sum_rows(np.where(bad, in_line, 0), at)

    n_repeat = _repeated(offsets, codes, max(1, len(vocabulary)))
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    kept = ~failed & (lost <= most_lost * n_words)
    keep_line = pa.array(~bad)
    left = np.concatenate([[0], np.cumsum(~bad)])[at]
    cleaned = pc.binary_join(pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), lines.filter(keep_line)), "\n")
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": _count(texts, r"[#*$%&|<>]"), "n_dup_lines": _sum_rows(later, at),
            "n_repeat_words": n_repeat, "lost_words": lost, "base_failed": failed, "kept": kept}, cleaned


def judge(docs: DataFrame, **rules) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words, base_failed, kept: a row per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    common = common_lines(docs)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                columns, _ = measure(part.column("text"), common=common, **rules)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id")} | {k: pa.array(v) for k, v in columns.items()})

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lost_words long,"
        " base_failed boolean, kept boolean")


def clean(docs: DataFrame, **rules) -> DataFrame:
    """The kept documents with their failing lines removed; same columns (``n_chars`` follows the text if it is there)."""
    names = docs.columns
    common = common_lines(docs)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                columns, cleaned = measure(part.column("text"), common=common, **rules)
                out = {c: part.column(i) for i, c in enumerate(names)} | {"text": cleaned}
                if "n_chars" in out:
                    out["n_chars"] = pc.utf8_length(cleaned).cast(out["n_chars"].type)
                yield pa.RecordBatch.from_arrays([out[c] for c in names], names).filter(pa.array(columns["kept"]))

    return docs.mapInArrow(run, docs.schema)
