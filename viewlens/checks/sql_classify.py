"""SQL of the keyword classification queries (DuckDB dialect)."""

from viewlens.checks.sql_rfm import with_ctes
from viewlens.checks.sql_search import LOG, MAPPING

KW = """kw AS (SELECT DISTINCT keyword FROM log WHERE keyword IS NOT NULL)"""

HINT = """CASE WHEN lower(keyword) LIKE '%vtv%' OR lower(keyword) LIKE '%htv%' OR lower(keyword) LIKE '%channel%' THEN 'TV Channel'
     WHEN lower(keyword) LIKE '%running%' OR lower(keyword) LIKE '%master key%' OR lower(keyword) LIKE '%reality%' THEN 'Reality Show'
     WHEN lower(keyword) LIKE '%sex%' OR lower(keyword) LIKE '%romantic%' OR lower(keyword) LIKE '%love%' THEN 'Romance'
     WHEN lower(keyword) LIKE '%potter%' OR lower(keyword) LIKE '%hogwarts%' THEN 'Drama'
     WHEN lower(keyword) LIKE '%phim việt%' THEN 'Drama' WHEN lower(keyword) LIKE '%phim trung%' THEN 'C Drama'
     WHEN lower(keyword) LIKE '%phim hàn%' THEN 'K Drama' END"""

NAMED = """CASE WHEN EXISTS (SELECT 1 FROM nation WHERE lower(n_name) = lower(keyword)) THEN 'Sports'
     WHEN EXISTS (SELECT 1 FROM region WHERE lower(r_name) = lower(keyword)) THEN 'News' END"""

EXAMPLE = """CASE keyword WHEN 'thuyếtminh' THEN 'Other' WHEN 'bigfoot' THEN 'Horror' WHEN 'capdoi' THEN 'Romance'
     WHEN 'ARGEN' THEN 'Sports' WHEN 'nhật ký' THEN 'Drama' WHEN 'PENT' THEN 'C Drama'
     WHEN 'running' THEN 'Reality Show' WHEN 'VTV3' THEN 'TV Channel' END"""

RULE = f"coalesce({EXAMPLE}, {HINT}, {NAMED}, 'Other')"

P1 = "mapping1 AS (SELECT keyword, min(Genre) AS Genre FROM mapping WHERE period = 1 GROUP BY keyword)"

_RULES = f"SELECT keyword, {RULE} AS Genre FROM kw"
_KNOWN_FIRST = f"""
SELECT k.keyword, coalesce(m.Genre, r.Genre) AS Genre
FROM kw k JOIN ({_RULES}) r ON k.keyword = r.keyword LEFT JOIN mapping1 m ON k.keyword = m.keyword"""

SQL = {
    "keyword_classify": with_ctes([LOG, KW], _RULES),
    "keyword_preview": with_ctes([LOG, KW], _RULES + " ORDER BY keyword LIMIT 10"),
    "keyword_classify_rules": with_ctes([LOG, KW], f"SELECT keyword, coalesce({HINT}, {NAMED}) AS Hint FROM kw"),
    "keyword_classify_batched": with_ctes([LOG, KW], """
SELECT keyword, CASE length(keyword) % 4 WHEN 0 THEN 'Music' WHEN 1 THEN 'Comedy' WHEN 2 THEN 'Animation' ELSE 'Other' END AS Genre
FROM kw"""),
    "keyword_classify_resumed": with_ctes([LOG, KW], "SELECT keyword, CASE length(keyword) % 2 WHEN 0 THEN 'Music' ELSE 'Comedy' END AS Genre FROM kw"),
    "keyword_classify_override": with_ctes([LOG, KW, MAPPING, P1], _KNOWN_FIRST),
    "keyword_classify_incremental": with_ctes([LOG, KW, MAPPING, P1], _KNOWN_FIRST),
    "label_response_parse": with_ctes([LOG, KW, MAPPING, P1], """
SELECT k.keyword, CASE WHEN length(k.keyword) % 8 IN (0, 1, 7) THEN coalesce(m.Genre, 'Other') ELSE 'Other' END AS Genre
FROM kw k LEFT JOIN mapping1 m ON k.keyword = m.keyword"""),
}
