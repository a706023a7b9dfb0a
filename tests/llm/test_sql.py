"""Operators against their SQL: the given tables, and awkward rows."""

import zlib

import duckdb
import pyarrow as pa
import pytest
from frames import EDGE, SF, documents, near_copies
from viewlens.checks.compare import compare_one, duck
from viewlens.llm import chosen_path, sharding, spelling
from viewlens.llm.queries import QUERIES, SQL
from viewlens.llm.sql import PIECE, crc32

OPERATORS = {"op3_contiguous_shards": sharding.shard, "op9_chosen_path_join": chosen_path.join, "op13_spelling_forms": spelling.forms}
VARIANTS = [(100 + i, t) for i, t in enumerate(
    ["colour colour color color color color colors Colors COLORS Größe größe Große große große große",
     "naïve naïve naïve naive naive naive naive naive naive native native native", "abcde abcde abcde abcdf abcdf abcdf abcdg abcdg abcdg"])]
ROWS = {"edge": EDGE, "copies": near_copies(4, 12) + near_copies(9, 5, base=40) + [(1, "same")] * 30, "variants": VARIANTS + EDGE, "empty": []}


@pytest.mark.parametrize("name", OPERATORS)
def test_tables(spark, name):
    r = compare_one(spark, duck(SF), name, QUERIES[name], SQL[name], SF)
    assert r["ok"], r


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("rows", ROWS)
def test_rows(spark, name, rows):
    got = OPERATORS[name](documents(spark, ROWS[rows]))
    ids, texts = ([r[j] for r in ROWS[rows]] for j in (0, 1))
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
    con = duckdb.connect()
    con.register("documents", table)
    want = con.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)


@pytest.mark.parametrize("length", [0, 1, PIECE - 1, PIECE, PIECE + 1, 3 * PIECE + 7])
def test_crc32(length):
    text = ("aé€\U0001f600" * 900)[:length]
    con = duckdb.connect()
    assert con.execute(f"SELECT {crc32('s')} FROM (SELECT ? AS s)", [text]).fetchall() == [(zlib.crc32(text.encode()),)]
    con.register("documents", pa.table({"doc_id": [1], "text": [text]}))
    assert con.execute(f"SELECT text_crc32 FROM ({SQL['op3_contiguous_shards']})").fetchall() == [(zlib.crc32(text.encode()),)]
