"""Spelling variants by composing finite-state machines.

Two words are near if one is read into the other by exactly one inserted, deleted or replaced code point. The vocabulary's minimal
acceptor is composed with the transducer that makes one edit and with the acceptor again. Before the edit both sides read the same
letters, so a state of the composition is one acceptor state; at the edit it parts into two; after it both read the same letters to their
ends. The edit stands where two words first differ, so each pair is accepted once.

The composition is cut by initial state. A pair whose first two letters agree lies among the words that leave the start by those two
letters. Any other pair of words of five letters or more agrees in its last three, and lies among the reversed words that leave the start
of the reversed acceptor by these. A part of more than ``most`` words is cut again at its state: pairs that edit there agree in what
follows the edit, which at most an alphabet's number of words share, and all others agree in one more letter (words that share more are
moved on to where they part). So a task holds bounded parts however many words share a beginning, and no word is left out. A part returns
a word's number of near words and its best one, not its pairs.

Defined cases: a null text has no words, a null doc_id is the empty text in the hash; every occurrence counts, in repeated rows too; a
word without near words has n_near 0 and is its own root; ties go to the smallest form in code-point order; words of any length are
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlens.llm.common import ship
from viewlens.session import stored

ship(__name__)

RUN = "[A-Za-zÀ-ÿ]+"
EVERY = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
RATIO = 2
#: Letters that select a part at first: of the beginning, of the end. A pair of words of LEAST_LENGTH agrees in one of both.
BEGIN, END = 2, 3
#: Words of a part.
MOST = 2_000


def runs(docs: DataFrame) -> DataFrame:
    """run: the letters of a document's words, one code point less where the hash says so."""
    folded = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all(folded, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    each = each.select("run", F.when(F.pmod(h, F.lit(EVERY)) == 0, F.pmod(h, F.length("run").cast("long")).cast("int")).alias("gone"))
    less = F.concat(F.substring("run", F.lit(1), F.col("gone")), F.expr("substring(run, gone + 2)"))
    return each.select(F.when(F.col("gone").isNull(), F.col("run")).otherwise(less).alias("run"))


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: counted in every task before the shuffle."""
    words = runs(docs).filter(F.length("run") >= least_length).groupBy(F.col("run").alias("word"))
    return words.agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def acceptor(words) -> tuple[list[dict[str, int]], list[bool]]:
    """The minimal acceptor of sorted distinct words: (arcs of each state by letter, whether a word ends there); state 0 is the start."""
    arcs, final, known, path, before = [{}], [False], {}, [0], ""

    def settle(keep: int) -> None:  # states below the shared path are complete: an equal one takes their place
        while len(path) - 1 > keep:
            state = path.pop()
            arcs[path[-1]][before[len(path) - 1]] = known.setdefault((final[state], *arcs[state].items()), state)

    for word in words:
        same = 0
        while same < len(before) and same < len(word) and before[same] == word[same]:
            same += 1
        settle(same)
        for letter in word[same:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][letter] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        before = word
    settle(0)
    return arcs, final


def common(arcs, final, p: int, q: int, longest: int | None):
    """What can be read to an end from both states, at most ``longest`` letters of it."""
    todo = [(p, q, "")]
    while todo:
        p, q, read = todo.pop()
        if final[p] and final[q]:
            yield read
        if longest is None or len(read) < longest:
            other = arcs[q]
            todo += [(to, other[letter], read + letter) for letter, to in arcs[p].items() if letter in other]


def edits(arcs, final, state: int, longest: int | None) -> list[tuple[str, str]]:
    """Pairs of different endings from a state that one edit of their first letter makes equal; a deletion only if they differ there."""
    out, ways = [], list(arcs[state].items())
    for j, (a, to) in enumerate(ways):
        for b, other in ways[:j]:
            out += [(a + rest, b + rest) for rest in common(arcs, final, to, other, longest)]
        out += [(a + rest, rest) for rest in common(arcs, final, to, state, longest) if rest[:1] != a]
    return out


def near_pairs(words: list[str], longest: int | None = None, here: bool = False):
    """Pairs of sorted distinct words that the composition accepts, editing at the start only if ``here``."""
    arcs, final = acceptor(words)
    made = {}
    todo = [(0, "")]
    while todo:
        state, read = todo.pop()
        if state not in made:
            made[state] = edits(arcs, final, state, longest)
        for a, b in made[state]:
            yield read + a, read + b
        if not here:
            todo += [(to, read + letter) for letter, to in arcs[state].items()]


def _agree(a: str, b: str) -> int:
    return next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def _part_rows(back: bool, here: bool, depth: int, spelled: list[str], counts: list[int]):
    """(word, near words, the best one's count, the best one) of a part's words that have near ones."""
    n = dict(zip(spelled, counts, strict=True))
    start, best = spelled[0][:depth], {}
    for a, b in near_pairs([s[depth:] for s in spelled], BEGIN - 1 if back else None, here):
        a, b = start + a, start + b
        if back and _agree(a[::-1], b[::-1]) >= BEGIN:  # accepted by their beginning
            continue
        for one, other in ((a, b), (b, a)):
            got = best.setdefault(one, [0, 0, ""])
            got[0] += 1
            form = other[::-1] if back else other
            if (-n[other], form) < (-got[1], got[2]) or not got[2]:
                got[1:] = n[other], form
    return [(w[::-1] if back else w, *got) for w, got in best.items()]


def _compose(batches):
    """Parts follow each other, their words sorted; a part may go on in the next batch."""
    part, spelled, counts, rows = None, [], [], []

    def closed():
        if len(spelled) > 1:
            back, _, here, depth = part
            rows.extend(_part_rows(back, here, depth, spelled, counts))

    def batch_of(rows):
        kinds = {"word": pa.string(), "n_near": pa.int64(), "best_n": pa.int64(), "best": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds.values())], list(kinds))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("back", "part", "here", "depth", "spelled", "n")]
        for *key, word, n in zip(*columns, strict=True):
            if key != part:
                closed()
                part, spelled, counts = key, [], []
            spelled.append(word)
            counts.append(n)
        yield batch_of(rows)
        rows.clear()
    closed()
    yield batch_of(rows)


def _first_difference(a: Column, b: Column) -> Column:
    """Letters that two strings share at their beginning."""
    other = F.filter(F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)), F.lit(1))), lambda j: a.substr(j, F.lit(1)) != b.substr(j, F.lit(1)))
    return F.coalesce(F.get(other, F.lit(0)) - 1, F.least(F.length(a), F.length(b)))


def parts(words: DataFrame, most: int = MOST) -> DataFrame:
    """back, part, here, depth, spelled, n: every word in every part that it needs, no part of more than ``most`` words.

    ``part`` are the letters that the words agree in (and, where the edit stands ``here``, what follows it)."""
    sides = F.array(F.struct(F.lit(False).alias("back"), F.lit(BEGIN).alias("depth"), F.col("word").alias("spelled")),
                    F.struct(F.lit(True).alias("back"), F.lit(END).alias("depth"), F.reverse("word").alias("spelled")))
    part = F.expr("substring(spelled, 1, depth)").alias("part")
    key = ["back", "depth", "part"]
    todo = words.select(F.explode(sides).alias("s"), "n").select("s.back", "s.depth", "s.spelled", "n").withColumn("part", part)
    out = []
    while True:
        todo = stored(todo, "spelling-parts")
        sizes = todo.groupBy(*key).agg(F.count("*").alias("words"), F.min("spelled").alias("least"), F.max("spelled").alias("last"))
        large = stored(sizes.filter(F.col("words") > most), "spelling-large")
        if large.isEmpty():
            out.append(todo.withColumn("here", F.lit(False)))
            break
        out.append(todo.join(large, key, "left_anti").withColumn("here", F.lit(False)))
        shared = large.select(*key, _first_difference(F.col("least"), F.col("last")).alias("shared"))
        todo = todo.join(shared, key).drop("depth", "part").withColumnRenamed("shared", "depth")
        after = [F.expr("substring(spelled, depth + 2)"), F.expr("substring(spelled, depth + 1)")]  # the edit's letter left out, or none
        there = todo.select("back", "depth", "spelled", "n", part, F.explode(F.array(*after)).alias("rest"))
        there = there.filter(F.length("spelled") >= F.col("depth")).distinct()
        out.append(there.select("back", "depth", "spelled", "n", F.concat("part", F.lit("\n"), "rest").alias("part"), F.lit(True).alias("here")))
        todo = todo.filter(F.length("spelled") > F.col("depth")).withColumn("depth", F.col("depth") + 1).withColumn("part", part)
    names = ["back", "part", "here", "depth", "spelled", "n"]
    whole = out[0].select(*names)
    for more in out[1:]:
        whole = whole.unionByName(more.select(*names))
    return whole


def nearest(words: DataFrame, most: int = MOST) -> DataFrame:
    """word, n_near, best_n, best: the words that have near ones, and the best of these."""
    dealt = parts(words, most)
    sizes = dealt.groupBy("back", "part", "here").agg(F.count("*").alias("members")).filter(F.col("members") > 1).drop("members")
    dealt = dealt.join(sizes, ["back", "part", "here"], "left_semi")  # a word alone in its part has no near one there
    dealt = dealt.repartition("back", "part", "here").sortWithinPartitions("back", "part", "here", "depth", "spelled")
    found = dealt.mapInArrow(_compose, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best")


def roots(links: DataFrame) -> DataFrame:
    """word, root: links (word, form) followed to their ends. Every round doubles the steps; a form is RATIO times as frequent as its
    word, so some six rounds are the most."""
    at = stored(links.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "spelling-roots")
    while not at.filter("open").isEmpty():
        on = at.select(F.col("word").alias("by"), F.col("root").alias("further"))
        at = stored(at.join(on, at.root == on.by, "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("open")),
                    "spelling-roots")
    return at.select("word", "root")


def forms(docs: DataFrame, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row per word."""
    words = stored(vocabulary(docs), "spelling-words")
    found = words.join(nearest(words, most), "word", "left")
    taken = F.col("best_n") >= RATIO * F.col("n")
    found = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(taken, F.col("best")).alias("form"), F.when(taken, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(found.filter(F.col("form").isNotNull()).select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
