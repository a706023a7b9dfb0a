"""DuckDB SQL of operators whose result is exact: sharding, the Jaccard join, spelling forms.

They say the results plainly, by other ways than the operators: CRC-32 by its definition, all pairs that share a shingle, classes by
reachability, near words by one deleted letter.
"""

from __future__ import annotations

POLYNOMIAL = 0xEDB88320
FULL = 0xFFFFFFFF
#: Bytes of a piece of a long text in CRC-32.
PIECE = 128


def _nibble(c: int) -> int:
    for _ in range(4):
        c = c >> 1 ^ (POLYNOMIAL if c & 1 else 0)
    return c


_NIBBLES = f"{[_nibble(c) for c in range(16)]}::BIGINT[]"


def _after(start: str, digits: str) -> str:
    """The state of CRC-32 after ``start`` has read bytes given as hexadecimal digits."""
    each = f"list_transform(range(length({digits})), lambda i: instr('123456789ABCDEF', substr({digits}, i + 2 - 2 * (i % 2), 1))::BIGINT)"
    return f"list_reduce({each}, lambda c, b: xor(({_NIBBLES})[(xor(c, b) & 15) + 1], c >> 4), ({start})::BIGINT)"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a short text's UTF-8 bytes, as an expression."""
    return f"xor({_after(str(FULL), f'hex(encode({text}))')}, {FULL})"


#: The checksum of long texts is linear: pieces are read alone, moved on by the bytes behind them (``ahead``: what each bit becomes after
#: k whole pieces) and combined by exclusive or. Only the first piece, the one that may be short, starts from ones.
SHARD_SQL = f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT text, hex(encode(text)) AS digits, strlen(text)::BIGINT AS n FROM (SELECT DISTINCT text FROM d)),
p AS (SELECT text, k, k = (n - 1) // {PIECE} AS first,
             substr(digits, 2 * greatest(0, n - {PIECE} * (k + 1)) + 1, 2 * least({PIECE}, n - {PIECE} * k)) AS digits
      FROM (SELECT *, unnest(range((n + {PIECE - 1}) // {PIECE})) AS k FROM t)),
s AS (SELECT text, k, {_after(f"CASE WHEN first THEN {FULL} ELSE 0 END", "digits")} AS c FROM p),
step AS (SELECT list(moved ORDER BY bit) AS m
         FROM (SELECT bit, {_after("1::BIGINT << bit::INTEGER", f"repeat('0', {2 * PIECE})")} AS moved FROM range(32) r(bit))),
ahead AS (SELECT 0::BIGINT AS k, list_transform(range(32), lambda b: 1::BIGINT << b::INTEGER) AS bits
          UNION ALL
          SELECT k + 1, list_transform(bits, lambda x: list_reduce(range(32), lambda c, b: xor(c, m[b + 1] * ((x >> b::INTEGER) & 1)), 0::BIGINT))
          FROM ahead, step WHERE k < (SELECT max(k) FROM s)),
crc AS (SELECT text, xor(bit_xor(list_reduce(range(32), lambda a, b: xor(a, bits[b + 1] * ((c >> b::INTEGER) & 1)), 0::BIGINT)), {FULL}) AS text_crc32
        FROM s JOIN ahead USING (k) GROUP BY text),
r AS (SELECT doc_id, strlen(text)::BIGINT + 8 AS size, coalesce(text_crc32, 0) AS text_crc32 FROM d LEFT JOIN crc USING (text)),
o AS (SELECT *, sum(size) OVER w - size AS start, sum(size) OVER () AS total, row_number() OVER w AS place FROM r
      WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, (start * 24 // total)::INTEGER AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot,
       NULL::INTEGER AS grown_shard FROM c"""

JOIN_SQL = r"""WITH RECURSIVE t AS (
  SELECT text, count(*) AS copies, min(doc_id) AS rep, row_number() OVER (ORDER BY text) AS tid FROM documents WHERE text IS NOT NULL GROUP BY text),
w AS (SELECT tid, len(w) AS words, unnest(w) AS word, unnest(range(len(w))) AS place FROM (SELECT tid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t)),
g AS (SELECT tid, words, place, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS sh
      FROM w WINDOW o AS (PARTITION BY tid ORDER BY place)),
s AS (SELECT DISTINCT tid, sh FROM g WHERE place < greatest(words - 4, 1)),
n AS (SELECT tid, count(*) AS n FROM s GROUP BY tid),
p AS (SELECT a.tid AS a, b.tid AS b, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.tid <> b.tid GROUP BY a.tid, b.tid),
near AS (SELECT a, b FROM p JOIN n x ON a = x.tid JOIN n y ON b = y.tid WHERE 5 * shared >= 4 * (x.n + y.n - shared)),
links AS (SELECT a AS tid, sum(copies)::BIGINT AS links FROM near JOIN t ON b = t.tid GROUP BY a),
reach(tid, met) AS (SELECT tid, tid FROM t UNION SELECT reach.tid, near.b FROM reach JOIN near ON reach.met = near.a),
class AS (SELECT reach.tid, min(t.rep) AS class_id FROM reach JOIN t ON reach.met = t.tid GROUP BY reach.tid)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN d.doc_id ELSE class_id END AS class_id,
       CASE WHEN d.text IS NULL THEN 0 ELSE copies - 1 + coalesce(links, 0) END::BIGINT AS n_links
FROM documents d LEFT JOIN t ON d.text = t.text LEFT JOIN class USING (tid) LEFT JOIN links USING (tid)"""

SPELLING_SQL = rf"""WITH RECURSIVE r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
g AS (SELECT doc, run, count(*) AS times FROM r GROUP BY doc, run),
h AS (SELECT run, times, {crc32("doc || ':' || run")} AS h FROM g),
e AS (SELECT times, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
v AS (SELECT word, sum(times)::BIGINT AS n FROM e WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
x AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM v)),
near AS (SELECT a.word, b.word AS other, b.n FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION ALL SELECT DISTINCT x.word, v.word, v.n FROM x JOIN v ON x.rest = v.word
         UNION ALL SELECT DISTINCT v.word, x.word, x.n FROM x JOIN v ON x.rest = v.word),
best AS (SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, n AS other_n,
                row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place FROM near),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
             CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n FROM v LEFT JOIN best ON v.word = best.word AND place = 1),
path(word, stop) AS (SELECT word, word FROM f UNION ALL SELECT path.word, f.form FROM path JOIN f ON path.stop = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, path.stop AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM f JOIN path ON f.word = path.word JOIN f AS last ON path.stop = last.word AND last.form IS NULL"""
