"""Exact global ``ntile`` from cut points bracketed by quantile sketches.

``ntile(n)`` needs only the n - 1 rows at which a new tile starts. Two passes over the rows find them, whatever the values:

1. One mergeable KLL sketch per score gives, for every cut, a bracket of values that holds the wanted rank.
2. One aggregate counts the rows between the brackets and the rows of each value inside them; running totals over what is
   inside, a bounded share of the rows, name the exact rows.

Key and id are one number where both ranges fit 62 bits, so ties need nothing more. Where they do not, the two passes find
the key values, and the same two passes over the ids of each tied value find the rows. A sketch's bounds hold with high
probability, so a bracket can miss its rank; that is seen from the counts, and the brackets are widened until they hold it.
Tiles are then assigned in one projection that compares each row with the cut rows.

No global sort, no row numbers, no task that holds more than its share of the input.

Order keys are integral, date or decimal columns (decimals up to 18 digits after scaling); NULL keys come first. Ids must be
integral, unique and not NULL; a cut that falls on rows with equal key and id raises.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of one number that holds key and id.
BITS = 62
#: Rows that the brackets of one score should hold at most; larger tables take larger sketches, within SKETCH.
BRACKET_ROWS = 1_000_000
SKETCH = (1024, 65_535)
#: Sketches of tasks are merged in so many groups before the last merge.
MERGE_GROUPS = 64


@dataclass
class _Order:
    """A total order to cut: its value, the rows it covers, their number, the wanted 1-based ranks; found: rank -> (value, rows with it, rows below)."""

    value: Column
    rows: int
    ranks: list[int]
    where: Column | None = None
    found: dict[int, tuple[int, int, int]] | None = None


def tile_starts(total: int, n: int) -> list[int]:
    """1-based row numbers at which tiles 2..n start (tiles beyond the last row do not)."""
    q, r = divmod(total, n)
    starts, at = [], 1
    for tile in range(1, n):
        at += q + (tile <= r)
        if at <= total:
            starts.append(at)
    return starts


def _sort_key(df: DataFrame, c: Column) -> Column:
    """The order key as a long with the same order."""
    kind = df.select(c).schema.fields[0].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.DecimalType):
        return (c * F.lit(10**kind.scale)).cast("decimal(38,0)").cast("long")
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    raise TypeError(f"ntile order key of type {kind.simpleString()}: integral, date or decimal expected")


def _sort_keys(df: DataFrame, orders: Mapping[str, Column | str]) -> list[Column]:
    return [_sort_key(df, F.col(o) if isinstance(o, str) else o) for o in orders.values()]


def ranges(df: DataFrame, orders: Mapping[str, Column | str], id_col: str) -> list[Column]:
    """Aggregates that ``global_ntiles`` needs first: rows, ids, least and largest id and keys. A job that writes the table can observe
    them (``DataFrame.observe``), which saves a pass."""
    i = F.col(id_col).cast("long")
    out = [F.count(F.lit(1)).alias("rows"), F.count(i).alias("ids"), F.min(i).alias("id_lo"), F.max(i).alias("id_hi")]
    for j, key in enumerate(_sort_keys(df, orders)):
        out += [F.min(key).alias(f"lo{j}"), F.max(key).alias(f"hi{j}")]
    return out


def _sketch_size(rows: int, cuts: int) -> tuple[int, float]:
    """(size, rank margin) of the sketch of an order: a sketch of size k misses a rank by more than 3 / k^0.9 of the rows only rarely."""
    want = BRACKET_ROWS / max(1, 2 * rows * cuts)
    k = min(SKETCH[1], max(SKETCH[0], math.ceil((3 / min(want, 1.0)) ** (1 / 0.9))))
    return k, 3 / k**0.9


def _brackets(keyed: DataFrame, orders: list[_Order], widen: float) -> list[list[tuple[int, int]]]:
    """Per order, disjoint ascending ranges of values that hold its ranks (in all likelihood): one pass."""
    sizes = [_sketch_size(o.rows, len(o.ranks)) for o in orders]
    values = [o.value if o.where is None else F.when(o.where, o.value) for o in orders]
    parts = keyed.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("g")).agg(
        *[F.kll_sketch_agg_bigint(v, F.lit(k)).alias(f"s{j}") for j, (v, (k, _)) in enumerate(zip(values, sizes, strict=True))])
    merged = parts.agg(*[F.kll_merge_agg_bigint(f"s{j}", F.lit(k)).alias(f"s{j}") for j, (k, _) in enumerate(sizes)])
    asked = []
    for o, (_, margin) in zip(orders, sizes, strict=True):
        ends = [(max(0.0, (r - 1) / o.rows - margin * widen), min(1.0, r / o.rows + margin * widen)) for r in o.ranks]
        asked.append(F.array(*[F.lit(x) for pair in ends for x in pair]))
    row = merged.select(*[F.kll_sketch_get_quantile_bigint(f"s{j}", a).alias(f"q{j}") for j, a in enumerate(asked)]).first()
    out = []
    for ends in row:
        joined: list[tuple[int, int]] = []
        for lo, hi in sorted(zip(ends[::2], ends[1::2], strict=True)):
            if joined and lo <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(hi, joined[-1][1]))
            else:
                joined.append((lo, hi))
        out.append(joined)
    return out


def _settle(keyed: DataFrame, orders: list[_Order], brackets: list[list[tuple[int, int]]]) -> None:
    """The rows at the wanted ranks, as far as the brackets hold them: one pass, whose totals outside the brackets are a row each."""
    places, marks, wanted = [], [], []
    for j, (o, ranges_) in enumerate(zip(orders, brackets, strict=True)):
        cases = " ".join(f"WHEN v{j} < CAST('{lo}' AS BIGINT) THEN {2 * b} WHEN v{j} <= CAST('{hi}' AS BIGINT) THEN {2 * b + 1}"
                         for b, (lo, hi) in enumerate(ranges_))
        places.append(f"CASE WHEN v{j} IS NOT NULL THEN CASE {cases} ELSE {2 * len(ranges_)} END END AS at{j}")  # odd: in a bracket
        marks.append(f"struct({j} AS o, at{j} AS at, IF(at{j} % 2 = 1, v{j}, NULL) AS value)")
        ranks = ", ".join(f"{r}L" for r in o.ranks)
        wanted.append(f"(o = {j} AND exists(array({ranks}), r -> r <= upto AND r > upto - n))")
    values = [(o.value if o.where is None else F.when(o.where, o.value)).alias(f"v{j}") for j, o in enumerate(orders)]
    rows = keyed.select(*values).selectExpr("*", *places).selectExpr(f"inline(array({', '.join(marks)}))").filter("at IS NOT NULL")
    counts = rows.groupBy("o", "at", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("o").orderBy("at", "value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("upto", F.sum("n").over(upto))
    found = counts.filter(f"value IS NOT NULL AND ({' OR '.join(wanted)})").collect()  # one row per cut at most
    for j, o in enumerate(orders):
        o.found = {r: (row.value, row.n, row.upto - row.n) for r in o.ranks for row in found
                   if row.o == j and row.upto - row.n < r <= row.upto}


def _select(keyed: DataFrame, orders: list[_Order]) -> None:
    """Finds all wanted ranks of all orders."""
    todo, widen = [o for o in orders if o.ranks], 1.0
    while todo:
        _settle(keyed, todo, _brackets(keyed, todo, widen))
        todo, widen = [o for o in todo if len(o.found) < len(o.ranks)], widen * 8


def global_ntiles(df: DataFrame, orders: Mapping[str, Column | str], n: int, id_col: str, known: Mapping | None = None) -> DataFrame:
    """Add one column per entry of ``orders``: ntile(n) over (order key ascending, NULLs first, id ascending).

    The input is read once per pass; pass a stored or cheap DataFrame. ``known``: the values of ``ranges``, if they are known already.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    keys = _sort_keys(df, orders)
    at = known if known is not None else df.agg(*ranges(df, orders, id_col)).first().asDict()
    if at["ids"] != at["rows"]:
        raise ValueError(f"{at['rows'] - at['ids']} rows have no {id_col}")
    i, total, ranks = F.col(id_col).cast("long"), at["rows"], tile_starts(at["rows"], n)
    id_lo, id_bits = at["id_lo"] or 0, ((at["id_hi"] or 0) - (at["id_lo"] or 0)).bit_length()
    first = [(at[f"lo{j}"] or 0) - 1 for j in range(len(keys))]  # NULL keys as the least value
    last = [at[f"hi{j}"] if at[f"hi{j}"] is not None else first[j] for j in range(len(keys))]
    keyed = df.select(i.alias("id"), *[F.coalesce(k, F.lit(v).cast("long")).alias(f"k{j}") for j, (k, v) in enumerate(zip(keys, first, strict=True))])
    one = [(hi - lo).bit_length() + id_bits <= BITS for lo, hi in zip(first, last, strict=True)]
    both = [F.shiftleft(F.col(f"k{j}") - F.lit(lo).cast("long"), id_bits) + (F.col("id") - F.lit(id_lo).cast("long")) for j, lo in enumerate(first)]
    found = [_Order(both[j] if one[j] else F.col(f"k{j}"), total, ranks) for j in range(len(keys))]
    _select(keyed, found)
    cuts: list[list[tuple[int, int]]] = [[] for _ in keys]  # per score, (key, id) of the rows at which tiles start
    tied: dict[tuple[int, int], _Order] = {}
    for j, o in enumerate(found):
        for r in ranks:
            value, rows, below = o.found[r]
            if one[j]:
                _unique(rows, id_col)
                cuts[j].append((first[j] + (value >> id_bits), id_lo + (value & ((1 << id_bits) - 1))))
            elif r == below + 1:
                cuts[j].append((value, id_lo))
            else:
                tied.setdefault((j, value), _Order(F.col("id"), rows, [], F.col(f"k{j}") == value)).ranks.append(r - below)
    _select(keyed, list(tied.values()))
    for (j, value), o in tied.items():
        for i_at, rows, _ in o.found.values():
            _unique(rows, id_col)
            cuts[j].append((value, i_at))
    out = {}
    for j, name in enumerate(orders):
        value, tile = F.coalesce(keys[j], F.lit(first[j]).cast("long")), F.lit(1)
        for key, cut_id in cuts[j]:
            tile = tile + F.when((value > key) | ((value == key) & (i >= cut_id)), 1).otherwise(0)
        out[name] = tile.cast("int")
    # one generated row, so that what is built on the tiles does not repeat the comparisons
    return df.select("*", F.inline(F.array(F.struct(*[tile.alias(name) for name, tile in out.items()]))))


def _unique(rows: int, id_col: str) -> None:
    if rows > 1:
        raise ValueError(f"{id_col} is not unique: {rows} rows with equal key and id at the start of a tile")


def global_ntile(df: DataFrame, order: str | Column, n: int, tiebreak: Sequence[str], out_col: str) -> DataFrame:
    """Add ``out_col`` = ntile(n) over (order, id) ascending; ``tiebreak`` names the id column."""
    if len(tiebreak) != 1:
        raise ValueError("one integral tie-break column expected")
    return global_ntiles(df, {out_col: order}, n, tiebreak[0])
