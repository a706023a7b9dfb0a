"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations


from viewlens.llm import (ann_tree, chat, chosen_path, cross_parse, fm_quality, hpy_lm, line_rules, maxscore, mixing, sharding, spelling,
                          whitening, word_bpe)
from viewlens.llm.common import documents
from viewlens.llm.sql import JOIN_SQL, SHARD_SQL, SPELLING_SQL

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


def _mix_round(k: int, before: str, state: str) -> str:
    """One round: candidates that fit what is left, by running totals over the hash."""
    return f"""
c{k} AS (SELECT d.source, d.h, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS cum, s.budget
        FROM {before} d JOIN {state} s ON d.source IS NOT DISTINCT FROM s.source WHERE NOT d.hit AND d.size <= s.budget),
f{k} AS (SELECT source, min(h) FILTER (cum > budget) AS t, coalesce(max(cum) FILTER (cum <= budget), 0) AS used FROM c{k} GROUP BY source),
d{k} AS (SELECT d.doc_id, d.source, d.size, d.h,
               d.hit OR (d.size <= s.budget AND f.source_found AND d.h < coalesce(f.t, 1152921504606846976)) AS hit
        FROM {before} d JOIN {state} s ON d.source IS NOT DISTINCT FROM s.source
        LEFT JOIN (SELECT *, true AS source_found FROM f{k}) f ON d.source IS NOT DISTINCT FROM f.source),
s{k} AS (SELECT s.source, s.source_size, s.target, s.full_passes, s.budget - coalesce(f.used, 0) AS budget
        FROM {state} s LEFT JOIN f{k} f ON s.source IS NOT DISTINCT FROM f.source),"""


MIX_SQL = r"""WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15))::BIGINT AS h, false AS hit FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size,
                   ([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM docs GROUP BY source),
levels AS (SELECT *, 2 * source_size AS cap, 2 * source_size / w AS ratio FROM sources),
l2 AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))
                 / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS lev
       FROM levels WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l3 AS (SELECT *, min_by(lev, ratio) FILTER (ratio >= lev) OVER () AS level FROM l2),
l4 AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(level * w, cap::DOUBLE)) AS target FROM l3),
st AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS full_passes FROM l4),
st0 AS (SELECT source, source_size, target, full_passes, target - full_passes * source_size AS budget FROM st),
""" + _mix_round(1, "docs", "st0") + _mix_round(2, "d1", "s1") + _mix_round(3, "d2", "s2") + """
z AS (SELECT 1)
SELECT d.doc_id, d.size, s.source_size, s.target, (s.full_passes + CASE WHEN d.hit THEN 1 ELSE 0 END) * d.size AS taken
FROM d3 d JOIN st0 s ON d.source IS NOT DISTINCT FROM s.source"""


@query("op1_mix_sources", MIX_SQL)
def op1_mix_sources(spark, sf):
    return mixing.mix(documents(spark, sf)).select("doc_id", "size", "source_size", "target", "taken")


CHAT_SQL = r"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
  length(role) + length(text)
  + len(regexp_extract_all(role, '[\\<#:\n]')) + len(regexp_extract_all(text, '[\\<#]')) + 4 + 2 + 8 AS chars FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant')::BIGINT AS n_examples
FROM t GROUP BY conv_id"""


@query("op2_chat_prefix_targets", CHAT_SQL)
def op2_chat_prefix_targets(spark, sf):
    control = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat.digests(rows.unionByName(own))


@query("op3_contiguous_shards", SHARD_SQL)
def op3_contiguous_shards(spark, sf):
    return sharding.shard(documents(spark, sf))


@query("op6_line_rules")
def op6_line_rules(spark, sf):
    return line_rules.judge(documents(spark, sf))


@query("op8_fm_quality")
def op8_fm_quality(spark, sf):
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    return fm_quality.score(docs, fm_quality.train(docs, labels))


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op10_word_bpe")
def op10_word_bpe(spark, sf):
    return word_bpe.encode_digests(documents(spark, sf), word_vocabulary())


@query("op9_chosen_path_join", JOIN_SQL)
def op9_chosen_path_join(spark, sf):
    return chosen_path.join(documents(spark, sf))


@query("op7_cross_parse_language")
def op7_cross_parse_language(spark, sf):
    docs = documents(spark, sf)
    return cross_parse.identify(docs, cross_parse.learn(docs))


@query("op5_kmeans_tree_search")
def op5_kmeans_tree_search(spark, sf):
    return ann_tree.search(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query("op4_pitman_yor_score")
def op4_pitman_yor_score(spark, sf):
    return hpy_lm.score(documents(spark, sf))


TOP_SQL = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
terms AS (SELECT vec_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS d FROM v),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
          FROM terms q JOIN terms c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5"""


@query("op11_maxscore_top", TOP_SQL)
def op11_maxscore_top(spark, sf):
    return maxscore.top(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query("op12_block_whitening")
def op12_block_whitening(spark, sf):
    return whitening.whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query("op13_spelling_forms", SPELLING_SQL)
def op13_spelling_forms(spark, sf):
    return spelling.forms(documents(spark, sf))
