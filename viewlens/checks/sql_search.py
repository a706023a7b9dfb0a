"""SQL of the search queries (DuckDB dialect)."""

from viewlens.checks.sql_rfm import with_ctes

_EXAMPLES = ["thuyếtminh", "bigfoot", "capdoi", "ARGEN", "nhật ký", "PENT", "running", "VTV3"]
_PREFIXES = ["HTV7 ", "Reality ", "LOVE ", "Harry Potter ", "Phim Việt ", "phim trung ", "PHIM HÀN "]
_CASES = " ".join([f"WHEN {i} THEN '{w}'" for i, w in enumerate(_EXAMPLES)]
                  + [f"WHEN {i} THEN '{w}' || p_name" for i, w in enumerate(_PREFIXES, start=8)])

PARTS = f"""parts AS (
  SELECT p_partkey, CASE p_partkey % 24 {_CASES} WHEN 15 THEN n_name WHEN 16 THEN r_name ELSE p_name END AS keyword
  FROM part LEFT JOIN nation ON n_nationkey = (p_partkey // 24) % 25 LEFT JOIN region ON r_regionkey = (p_partkey // 24) % 5)"""

LOG = PARTS + """,
log AS (
  SELECT CASE WHEN o.o_orderdate < TIMESTAMP '1998-05-01' THEN 1 ELSE 2 END AS period,
         CAST(o.o_custkey AS VARCHAR) AS user_id, p.keyword
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN parts p ON l.l_partkey = p.p_partkey)"""

COUNTS = """counts AS (
  SELECT period, user_id, keyword, count(keyword) AS search_count
  FROM log WHERE keyword IS NOT NULL GROUP BY period, user_id, keyword)"""

TOP = """top AS (
  SELECT period, user_id, keyword, search_count FROM (
    SELECT *, row_number() OVER (PARTITION BY period, user_id ORDER BY search_count DESC, keyword ASC) AS rn
    FROM counts) WHERE rn = 1)"""

_GENRE = """CASE split_part(keyword, ' ', 2) WHEN 'bolt' THEN 'Action' WHEN 'anvil' THEN 'Drama'
           WHEN 'ring' THEN 'Romance' WHEN 'gear' THEN 'Sports' WHEN 'widget' THEN 'TV Channel'
           WHEN 'rod' THEN 'News' WHEN 'plate' THEN 'Music' ELSE 'Comedy' END"""

MAPPING = f"""mapping AS (
  SELECT DISTINCT 1 AS period, keyword, {_GENRE} AS Genre
  FROM parts WHERE split_part(keyword, ' ', 1) <> 'old'
  UNION ALL
  SELECT DISTINCT 2 AS period, keyword,
         CASE WHEN split_part(keyword, ' ', 1) = 'red' THEN 'Other' ELSE {_GENRE} END AS Genre
  FROM parts WHERE split_part(keyword, ' ', 1) <> 'new')"""

MAPPED = """mapped AS (
  SELECT t.* FROM top t
  WHERE EXISTS (SELECT 1 FROM mapping m WHERE m.keyword = t.keyword AND m.period = t.period))"""

DIM = """dim AS (
  SELECT keyword, Genre FROM (
    SELECT keyword, Genre, row_number() OVER (PARTITION BY keyword ORDER BY period, Genre) AS rn
    FROM mapping WHERE keyword IS NOT NULL) WHERE rn = 1)"""

PIVOT = """user_pivot AS (
  SELECT user_id, max(CASE WHEN period = 1 THEN keyword END) AS Most_Searched_T6,
         max(CASE WHEN period = 2 THEN keyword END) AS Most_Searched_T7
  FROM mapped GROUP BY user_id
  HAVING max(CASE WHEN period = 1 THEN keyword END) IS NOT NULL
     AND max(CASE WHEN period = 2 THEN keyword END) IS NOT NULL)"""

ENRICHED = """enriched AS (
  SELECT p.user_id, p.Most_Searched_T6, d6.Genre AS Genre_T6, p.Most_Searched_T7, d7.Genre AS Genre_T7
  FROM user_pivot p LEFT JOIN dim d6 ON p.Most_Searched_T6 = d6.keyword LEFT JOIN dim d7 ON p.Most_Searched_T7 = d7.keyword)"""

RESULT = """search_result AS (
  SELECT *, CASE WHEN Genre_T6 = Genre_T7 THEN 'No Change' ELSE Genre_T6 || ' -> ' || Genre_T7 END AS Changing
  FROM enriched)"""

SEARCH_CTES = [LOG, COUNTS, TOP, MAPPING, MAPPED, DIM, PIVOT, ENRICHED, RESULT]

# Labels as the labelling step writes them: one row per user whose top
# keyword of the month is labelled for that month.
ADAPTER_MAPPING = MAPPING.replace("mapping AS (", "adapter_mapping AS (", 1)
LABELLED_MAPPING = """mapping AS (
  SELECT t.period, t.keyword, m.Genre FROM top t
  JOIN adapter_mapping m ON m.keyword = t.keyword AND m.period = t.period)"""
FROM_FILES_CTES = [LOG, COUNTS, TOP, ADAPTER_MAPPING, LABELLED_MAPPING, MAPPED, DIM, PIVOT, ENRICHED, RESULT]

SQL = {
    "search_counts": with_ctes([LOG, COUNTS], "SELECT * FROM counts"),
    **dict.fromkeys(("search_top_keyword", "search_top_keyword_incremental", "search_top_keyword_stream"),
                    with_ctes([LOG, COUNTS, TOP], "SELECT * FROM top")),
    "search_top_keyword_csv": with_ctes([LOG, COUNTS, TOP], "SELECT user_id, keyword, search_count FROM top"),
    "search_distinct_keywords": with_ctes([LOG], "SELECT count(DISTINCT keyword) AS distinct_keywords FROM log"),
    "search_keyword_popularity": with_ctes([LOG, COUNTS, TOP], """
SELECT period, keyword, count FROM (
  SELECT period, keyword, count(*) AS count,
         row_number() OVER (PARTITION BY period ORDER BY count(*) DESC, keyword ASC) AS rn
  FROM top GROUP BY period, keyword) WHERE rn <= 20"""),
    "search_mapped": with_ctes([LOG, COUNTS, TOP, MAPPING, MAPPED], "SELECT * FROM mapped"),
    "genre_dimension": with_ctes([PARTS, MAPPING, DIM], "SELECT * FROM dim"),
    "search_period_pivot": with_ctes([LOG, COUNTS, TOP, MAPPING, MAPPED, PIVOT], "SELECT * FROM user_pivot"),
    "search_genre_enrich": with_ctes(SEARCH_CTES[:-1], "SELECT * FROM enriched"),
    "search_changing": with_ctes(SEARCH_CTES, "SELECT * FROM search_result"),
    "search_changing_salted": with_ctes(SEARCH_CTES, "SELECT * FROM search_result"),
    "search_changing_bucketed": with_ctes(SEARCH_CTES, "SELECT * FROM search_result"),
    "search_from_files": with_ctes(FROM_FILES_CTES, "SELECT * FROM search_result"),
    "search_normalize": with_ctes(SEARCH_CTES, "SELECT * FROM search_result"),
    "search_period_scan": with_ctes([LOG], "SELECT user_id, keyword FROM log WHERE period = 1"),
}
