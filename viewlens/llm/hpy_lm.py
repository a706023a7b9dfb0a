"""Language-model scoring by a hierarchical Pitman-Yor bigram model.

Every context word has a restaurant whose customers are the words that followed it; its tables are customers of the one parent
restaurant of all words, whose base is uniform over the vocabulary and one unknown word. Seating is sampled by Gibbs sweeps:
a sweep seats all customers of a dish in turn, given the tables of the other dishes. After burn-in, the predictive
probabilities of ``SAMPLES`` seatings are averaged, and a text's score is the sum of their logarithms.

Blocks of documents send each distinct word pair once, with its count, to the part that owns its context. Parts merge the
pairs of all blocks, and exchange tables and parent probabilities by word with the parts that own the words: once
with one table a pair, once with the sampled tables. Then every block gets the averaged probability of each of its pairs
and scores its texts. A part seats by a generator seeded with its number, so work done again after a lost executor
gives the same tables. Nothing is collected; shuffled are distinct pairs and words of blocks and parts.

Tokens are words with A-Z in lower case, then one end. Words are told apart by hashes of log2(bytes) + 20 bits.
Discounts are estimated from counts of counts. The logarithms of pairs travel as 32-bit floats (8 digits), sums are doubles.

Defined cases: a null text is empty and has one token, its end; a null id folds as the empty text; repeated rows
count each; without training texts all probabilities are 1; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlens.llm.blocks import apart, dealt, pack_floats, pack_ints, texts_of, unpack_floats, unpack_ints
from viewlens.llm.common import coded, fold, hash_words, ship, split_words, text_bytes

ship(__name__)

FOLDS, HELD_OUT = 5, 1
STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 3
BLOCK_BYTES, PART_BYTES = 8 << 20, 16 << 20
START, END = 0, 1
_REQUEST = "part int, block int, u binary, nu binary, w binary, wi binary, c binary"
_MESSAGE = "part int, frm int, kind int, w binary, n binary, totals array<double>"


def owner(h: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """The part that owns a word; ascending with the hash."""
    return (((h >> np.uint64(bits - 32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def pairs_of(texts: pa.Array, bits: int):
    """(token offsets, word hashes, context, word of each token) with words as places in the ascending hashes."""
    offsets, words = split_words(texts, lower=True)
    codes, vocabulary = coded(words)
    h = np.maximum(hash_words(vocabulary) >> np.uint64(64 - bits), np.uint64(2))
    hashes = np.unique(np.concatenate([np.array([START, END], np.uint64), h]))
    own = np.searchsorted(hashes, h)[codes] if len(codes) else np.zeros(0, np.int64)
    n = np.diff(offsets)
    ends = np.cumsum(n + 1)  # each text's tokens and its end
    word = np.full(int(ends[-1]) if len(ends) else 0, END, np.int64)
    inside = np.ones(len(word), bool)
    inside[ends - 1] = False
    word[inside] = own
    context = np.empty_like(word)
    context[1:] = word[:-1]
    starts = ends - n - 1
    context[starts] = START
    return np.concatenate([[0], ends]), hashes, context, word


def seat(count: np.ndarray, rate: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of dishes with ``count`` customers seated in turn; a new table has weight ``rate``, an old one its customers less the discount."""
    tables = (count > 0).astype(np.float64)
    open_rows = np.flatnonzero(count > 1)
    for j in range(1, 32):
        if not len(open_rows):
            return tables
        a = rate[open_rows]
        tables[open_rows] += rng.random(len(open_rows)) * (a + j - discount * tables[open_rows]) < a
        open_rows = open_rows[count[open_rows] > j + 1]
    at = np.full(len(open_rows), 32.0)  # many customers: draw how many come before the next new table
    while len(open_rows):
        a = np.maximum(rate[open_rows], 1e-12)
        x = at - discount * tables[open_rows]
        with np.errstate(over="ignore"):
            at = at + np.floor(x * np.expm1(-np.log(rng.random(len(at))) / a)) + 1
        here = at <= count[open_rows]
        open_rows, at = open_rows[here], at[here]
        tables[open_rows] += 1
    return tables


def _request(bits: int, parts: int):
    def run(key, t):
        offsets, hashes, context, word = pairs_of(texts_of(t), bits)
        learn = np.repeat(np.where(t["held_out"].to_numpy(), 0, t["copies"].to_numpy()), np.diff(offsets))
        m = len(hashes)
        code, place = np.unique(context * m + word, return_inverse=True)
        count = np.bincount(place, weights=learn.astype(np.float64), minlength=len(code)).astype(np.int64)
        u, w = code // m, code % m
        part = owner(hashes, bits, parts)
        cut = np.searchsorted(part, np.arange(parts + 1))
        at = np.searchsorted(u, cut)
        rows = []
        for p in range(parts):
            lo, hi = int(at[p]), int(at[p + 1])
            if hi > lo:
                names, local = np.unique(w[lo:hi], return_inverse=True)
                contexts, size = np.unique(u[lo:hi], return_counts=True)
                rows.append((p, pack_ints(hashes[contexts], True), pack_ints(size), pack_ints(hashes[names], True), pack_ints(local), pack_ints(count[lo:hi])))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        return pa.table({"part": pa.array(cols[0], pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         **{k: pa.array(c, pa.binary()) for k, c in zip(("u", "nu", "w", "wi", "c"), cols[1:], strict=True)}})
    return run


def _merge(t):
    """The part's distinct pairs: hashes of contexts and words, pairs as places in them, counts; the blocks' pairs as places in the pairs."""
    blocks = t["block"].to_numpy()
    us = [unpack_ints(b, True) for b in t["u"].to_pylist()]
    ws = [unpack_ints(b, True) for b in t["w"].to_pylist()]
    uh, wh = np.unique(np.concatenate(us)), np.unique(np.concatenate(ws))
    codes = []
    for u, nu, w, wi in zip(us, t["nu"].to_pylist(), ws, t["wi"].to_pylist(), strict=True):
        at = np.repeat(np.searchsorted(uh, u), unpack_ints(nu).astype(np.int64))
        codes.append(at * len(wh) + np.searchsorted(wh, w)[unpack_ints(wi).astype(np.int64)])
    ends = np.cumsum([0, *map(len, codes)])
    code, place = np.unique(np.concatenate(codes), return_inverse=True)
    del codes
    count = np.zeros(len(code))
    for lo, c in zip(ends[:-1], t["c"].to_pylist(), strict=True):
        c = unpack_ints(c).astype(np.float64)
        np.add.at(count, place[lo:lo + len(c)], c)
    return blocks, us, uh, wh, code // len(wh), code % len(wh), count, place, ends


def _messages(part: int, parts: int, bits: int, wh: np.ndarray, values: list, totals: list, kind: int):
    """A row for every part: its words here with their values, and this part's totals."""
    cut = np.searchsorted(owner(wh, bits, parts), np.arange(parts + 1))
    rows = [(q, pack_ints(wh[a:b], True), pack_ints(np.concatenate([v[a:b] for v in values]))) for q, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))]
    return pa.table({"part": pa.array([q for q, _, _ in rows], pa.int32()), "frm": pa.array([part] * parts, pa.int32()), "kind": pa.array([kind] * parts, pa.int32()),
                     "w": pa.array([w for _, w, _ in rows], pa.binary()), "n": pa.array([n for _, _, n in rows], pa.binary()),
                     "totals": pa.array([totals] * parts, pa.list_(pa.float64()))})


def _first_tables(bits: int, parts: int):
    """Every pair has one table. Totals: training tokens, training texts, known words, pairs seen once and twice."""
    def run(key, t):
        _, _, uh, wh, u, w, count, _, _ = _merge(t)
        seen = np.bincount(u, weights=count, minlength=len(uh))
        texts = float(seen[uh == START].sum())
        totals = [float(count.sum()), texts, float((seen[uh != START] > 0).sum()), float((count == 1).sum()), float((count == 2).sum())]
        return _messages(key[0].as_py(), parts, bits, wh, [np.bincount(w, weights=count > 0, minlength=len(wh)).astype(np.int64)], totals, 1)
    return run


def _sum_words(t, samples: int):
    """Values of the part's words summed over the senders, by sample; and the senders' words as places."""
    ws = [unpack_ints(b, True) for b in t["w"].to_pylist()]
    wh = np.unique(np.concatenate(ws))
    places = [np.searchsorted(wh, w) for w in ws]
    out = np.zeros((samples, len(wh)))
    for at, n in zip(places, t["n"].to_pylist(), strict=True):
        out[:, at] += unpack_ints(n).reshape(samples, len(at)) if len(at) else 0
    return places, out


def _answers(t, places, values: np.ndarray, totals: list, kind: int):
    """A row for every sender: the values of its words."""
    n = [pack_ints(values[:, at].ravel()) for at in places]
    return pa.table({"part": t["frm"], "frm": t["part"], "kind": pa.array([kind] * len(n), pa.int32()), "w": pa.array([None] * len(n), pa.binary()),
                     "n": pa.array(n, pa.binary()), "totals": pa.array([totals] * len(n), pa.list_(pa.float64()))})


def _answer_first(key, t):
    """Customers of each word in the parent when every pair has one table. Totals: customers, words, words with one and two."""
    places, n = _sum_words(t, 1)
    return _answers(t, places, n, [float(n.sum()), float((n > 0).sum()), float((n == 1).sum()), float((n == 2).sum())], 1)


def _discount(once: float, twice: float) -> float:
    return float(np.clip(once / max(1.0, once + 2 * twice), 0.05, 0.99))


def _values(t, kind: int, samples: int):
    """(values by sample and word in the part's order, totals summed over the senders) of one kind of answers."""
    mine = t.filter(pa.compute.equal(t["kind"], kind)).sort_by("frm")
    parts = [unpack_ints(n).reshape(samples, -1) for n in mine["n"].to_pylist()]
    return np.concatenate(parts, 1).astype(np.float64), np.sum([x for x in mine["totals"].to_pylist()], 0)


def _sample(part: int, merged, answers, globals_):
    """Tables of the sampled seatings: (pairs with two customers at least, tables by sample)."""
    _, _, uh, wh, u, w, count, _, _ = merged
    customers, (total, known, once, twice) = _values(answers, 1, 1)
    vocabulary, discount = globals_[2] + (globals_[1] > 0), _discount(globals_[3], globals_[4])
    root = _discount(once, twice)
    parent = (customers[0] - root * (customers[0] > 0) + (STRENGTH + root * known) / (vocabulary + 1)) / (STRENGTH + total)
    many = np.flatnonzero(count > 1)
    rng = np.random.default_rng(part)
    fixed = np.bincount(u, weights=count == 1, minlength=len(uh))
    tables, out = np.ones(len(many)), []
    for sweep in range(BURN_IN + SAMPLES):
        here = fixed + np.bincount(u[many], weights=tables, minlength=len(uh))
        tables = seat(count[many], (STRENGTH + discount * here[u[many]]) * parent[w[many]], discount, rng)
        if sweep >= BURN_IN:
            out.append(tables)
    return many, out, fixed, discount, root, vocabulary


def _sampled_tables(bits: int, parts: int):
    def run(key, t, answers):
        merged = _merge(t)
        part = key[0].as_py()
        # the owners' totals are the same in every part; those of the pairs come with the answers
        many, samples, _, _, root, vocabulary = _sample(part, merged, answers, _globals(answers))
        _, _, _, wh, _, w, count, _, _ = merged
        ones = np.bincount(w, weights=count == 1, minlength=len(wh))
        sums = [(ones + np.bincount(w[many], weights=x, minlength=len(wh))).astype(np.int64) for x in samples]
        return _messages(part, parts, bits, wh, sums, [root, float(vocabulary)], 2)
    return run


def _globals(answers):
    """Totals of the first messages, passed on by the owners in their answers."""
    mine = answers.filter(pa.compute.equal(answers["kind"], 0))
    return mine["totals"].to_pylist()[0]


def _answer_sampled(key, t):
    """Customers and sampled tables of each word in the parent. Totals: both, by sample."""
    places, n = _sum_words(t, SAMPLES)
    root, vocabulary = t["totals"].to_pylist()[0]
    rng = np.random.default_rng((7, key[0].as_py()))
    rate = np.full(n.shape[1], (STRENGTH + root * vocabulary) / (vocabulary + 1))
    tables = np.stack([seat(x, rate, root, rng) for x in n]) if n.shape[1] else n
    return _answers(t, places, np.concatenate([n, tables]), [*n.sum(1).tolist(), *tables.sum(1).tolist()], 2)


def _answer_blocks(key, t, answers):
    """log10 of the averaged probability of every pair, for each block in its own order; counts of its contexts."""
    merged = _merge(t)
    globals_ = _globals(answers)
    many, samples, fixed, discount, root, vocabulary = _sample(key[0].as_py(), merged, answers, globals_)
    blocks, us, uh, wh, u, w, count, place, ends = merged
    values, totals = _values(answers, 2, 2 * SAMPLES)
    seen = np.bincount(u, weights=count, minlength=len(uh))
    p = np.zeros(len(u))
    for s, own in enumerate(samples):
        customers, tables = values[s], values[SAMPLES + s]
        parent = (customers - root * tables + (STRENGTH + root * totals[SAMPLES + s]) / (vocabulary + 1)) / (STRENGTH + totals[s])
        here = fixed + np.bincount(u[many], weights=own, minlength=len(uh))
        mine = (count == 1).astype(np.float64)
        mine[many] = own
        p += (count - discount * mine + (STRENGTH + discount * here[u]) * parent[w]) / (STRENGTH + seen[u])
    logs = np.log10(p / SAMPLES)
    out = [(pack_floats(logs[place[lo:hi]]), pack_ints(seen[np.searchsorted(uh, own)])) for own, lo, hi in zip(us, ends[:-1], ends[1:], strict=True)]
    return pa.table({"block": t["block"], "part": t["part"], "logs": pa.array([x for x, _ in out], pa.binary()), "seen": pa.array([x for _, x in out], pa.binary()),
                     "globals": pa.array([globals_[:3]] * len(out), pa.list_(pa.float64()))})


def _score(bits: int):
    def run(key, t, answers):
        offsets, hashes, context, word = pairs_of(texts_of(t), bits)
        answers = answers.sort_by("part")
        logs = np.concatenate([unpack_floats(x) for x in answers["logs"].to_pylist()])
        seen = np.concatenate([unpack_ints(x) for x in answers["seen"].to_pylist()]).astype(np.float64)
        tokens, texts, known = answers["globals"].to_pylist()[0]
        m = len(hashes)
        code, place = np.unique(context * m + word, return_inverse=True)
        contexts = np.unique(context)
        if len(code) != len(logs) or len(contexts) != len(seen):
            raise ValueError(f"block {key[0]}: {len(code)} pairs, {len(logs)} answers")
        count = np.zeros(m)
        count[contexts] = seen
        count[END] = texts
        vocabulary = known + (texts > 0)
        base = np.log10((count + 0.5) / (tokens + 0.5 * (vocabulary + 1)))

        def total(x):
            return np.add.reduceat(x, offsets[:-1])
        return pa.table({"doc_id": t["doc_id"], "copies": t["copies"], "held_out": t["held_out"], "n_tokens": pa.array(np.diff(offsets)),
                         "n_known": pa.array(total((count > 0)[word].astype(np.int64))), "train_tokens": pa.array(np.full(len(offsets) - 1, int(tokens))),
                         "base_score": pa.array(total(base[word])), "score": pa.array(total(logs[place]))})
    return run


def score(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    bits = min(62, max(40, math.ceil(math.log2(max(2, text_bytes(docs)))) + 20))
    rows, parts = dealt(docs, (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), block_bytes=BLOCK_BYTES, part_bytes=PART_BYTES)
    asked = rows.groupBy("block").applyInArrow(_request(bits, parts), _REQUEST)
    first = asked.groupBy("part").applyInArrow(_first_tables(bits, parts), _MESSAGE)
    answers = first.groupBy("part").applyInArrow(_with_globals(_answer_first), _MESSAGE)
    sampled = asked.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_sampled_tables(bits, parts), _MESSAGE)
    both = answers.unionByName(sampled.groupBy("part").applyInArrow(_answer_sampled, _MESSAGE))
    logs = asked.groupBy("part").cogroup(both.groupBy("part")).applyInArrow(
        _answer_blocks, "block int, part int, logs binary, seen binary, globals array<double>")
    return apart(rows.groupBy("block").cogroup(logs.groupBy("block")).applyInArrow(
        _score(bits), f"doc_id {kind}, copies long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


def _with_globals(answer):
    """The answers, and for every sender a row (kind 0) with the totals of all senders; one owner sends them."""
    def run(key, t):
        out = answer(key, t)
        if key[0].as_py() != 0:
            return out
        totals = np.sum(t["totals"].to_pylist(), 0).tolist()
        n = t.num_rows
        return pa.concat_tables([out, pa.table({
            "part": t["frm"], "frm": t["part"], "kind": pa.array([0] * n, pa.int32()), "w": pa.array([None] * n, pa.binary()),
            "n": pa.array([None] * n, pa.binary()), "totals": pa.array([totals] * n, pa.list_(pa.float64()))})])
    return run
