"""Small frames with the awkward rows every operator must define."""

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977} x{i}" for i in range(30000))
PROSE = "the cat sat on the mat and looked at the dog in the yard. " * 3
EDGE = [(1, PROSE + "one"), (2, None), (3, ""), (4, " \t\n\x0b "), (None, "a null id has text"), (5, LONG), (6, PROSE + "one"), (6, PROSE + "one"),
        (7, "x"), (8, "a b\x0bc d\x1ce f \U0001f600 İ"), (9, "one two three four five"), (None, None), (10, "same id, one"), (10, "same id, two")]
#: Names that operators use inside.
CLASHING = ["block", "h", "size", "key", "score", "part", "tid", "path", "held_out", "rank", "n", "row", "state_source", "left", "own_key", "first_key"]


def documents(spark, rows=EDGE, extra=True):
    lang, source = ["en", "fr", None], ["b", "a", None, "c"]
    full = [(i, t, lang[k % 3], source[k % 4], None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if extra else df


def near_copies(seed, n, words=120, change=4, base=0):
    rng = random.Random(seed)
    text = [f"t{seed}_{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(text)
        for _ in range(rng.randrange(change + 1)):
            own[rng.randrange(words)] = f"c{rng.randrange(10**6)}"
        out.append((base + i, " ".join(own)))
    return out
