"""SQL of the report marts (DuckDB dialect)."""

from viewlens.checks.sql_content import content_ctes
from viewlens.checks.sql_rfm import RFM_CTES, with_ctes
from viewlens.checks.sql_search import SEARCH_CTES


# Both activity labels occur at this many of the log's 30 days.
CONTENT_CTES = content_ctes(threshold=26)


def ratio(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) <> 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END)"


def half_even1(n: str, d: str) -> str:
    """Exact n/d rounded half to even to one decimal (n >= 0, d > 0)."""
    num = f"(CAST({n} AS HUGEINT) * 10)"
    den = f"CAST({d} AS HUGEINT)"
    q, r = f"({num} // {den})", f"({num} % {den})"
    bump = f"(CASE WHEN 2 * {r} > {den} OR (2 * {r} = {den} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"(CASE WHEN {den} > 0 THEN CAST({q} + {bump} AS DOUBLE) / 10.0 END)"


def cents(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


def vc(table: str, col: str, name: str = "Count") -> str:
    return f"SELECT {col}, count(*) AS {name} FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}"


def top(table: str, col: str, k: int) -> str:
    return vc(table, col) + f" ORDER BY Count DESC, {col} ASC LIMIT {k}"


def share(inner: str, col: str) -> str:
    return f"SELECT {col}, Count, {ratio('Count', 'sum(Count) OVER ()')} AS Share FROM ({inner})"


def rfm(sel: str) -> str:
    return with_ctes(RFM_CTES, sel)


def content(sel: str) -> str:
    return with_ctes(CONTENT_CTES, sel)


def search(sel: str) -> str:
    return with_ctes(SEARCH_CTES, sel)


LABEL_COLS = [("Truyền Hình", "Total_Truyen_Hinh"), ("Phim Truyện", "Total_Phim_Truyen"),
              ("Giải Trí", "Total_Giai_Tri"), ("Thể Thao", "Total_The_Thao"), ("Thiếu Nhi", "Total_Thieu_Nhi")]

RFM_SEGMENTS = "'Champions', 'Loyal Customers', 'At Risk', 'Hibernating'"

_TOTAL_DURATION = " + ".join(f"coalesce(sum({c}), 0)" for _, c in LABEL_COLS)

_DURATIONS = " UNION ALL ".join(
    f"SELECT '{lab}' AS Category, CAST(coalesce(sum({c}), 0) AS BIGINT) AS Duration FROM profile"
    for lab, c in LABEL_COLS)

_AVG_DURATIONS = " UNION ALL ".join(
    f"SELECT '{lab}' AS Category, avg({c}) AS Avg_Duration FROM profile"
    for lab, c in LABEL_COLS)

_MW_MEANS = ", ".join(f"{half_even1(f'sum({c})', f'count({c})')} AS Avg_{c[len('Total_'):]}" for _, c in LABEL_COLS)

_HISTOGRAM = """, cap AS (SELECT CAST(trunc(quantile_cont(Total_Devices, 0.95)) AS BIGINT) AS _cap FROM profile),
clipped AS (SELECT least(Total_Devices, _cap) AS x FROM profile, cap WHERE Total_Devices IS NOT NULL),
bnd AS (SELECT min(x) AS _lo, max(x) AS _hi FROM clipped),
binned AS (
  SELECT CAST(CASE WHEN _hi = _lo THEN 0 ELSE least((x - _lo) * 40 // (_hi - _lo), 39) END AS INTEGER) AS bin, _lo, _hi
  FROM clipped, bnd)
SELECT bin, _lo + bin * (CAST(_hi - _lo AS DOUBLE) / 40.0) AS bin_start,
       _lo + (bin + 1) * (CAST(_hi - _lo AS DOUBLE) / 40.0) AS bin_end, count(*) AS Count
FROM binned GROUP BY bin, _lo, _hi"""

_GENRES = ["Action", "Romance", "Comedy", "Horror", "Animation", "Drama", "C Drama", "K Drama", "Sports",
           "Music", "Reality Show", "TV Channel", "News", "Other"]

_WIDE = ", ".join(f"CAST(coalesce(sum(CASE WHEN Genre_T7 = '{g}' THEN Count END), 0) AS BIGINT) AS \"{g}\""
                  for g in _GENRES)

_PAIRS = """SELECT Genre_T6, Genre_T7, count(*) AS Count FROM search_result
  WHERE Genre_T6 IS NOT NULL AND Genre_T7 IS NOT NULL GROUP BY Genre_T6, Genre_T7"""

_FLOWS = f""", flows AS (
  SELECT Genre_T6, Genre_T7, Count AS count,
         row_number() OVER (ORDER BY Count DESC, Genre_T6, Genre_T7) AS _rank
  FROM ({_PAIRS}) ORDER BY Count DESC, Genre_T6, Genre_T7 LIMIT 20),
nodes AS (
  SELECT row_number() OVER (ORDER BY _side, _first) - 1 AS node_index, label FROM (
    SELECT label, _side, min(_rank) AS _first FROM (
      SELECT Genre_T6 || ' (T6)' AS label, 0 AS _side, _rank FROM flows
      UNION ALL SELECT Genre_T7 || ' (T7)' AS label, 1 AS _side, _rank FROM flows)
    GROUP BY label, _side))
"""

def all_counts(table: str, sets: dict[str, tuple[str, ...]]) -> str:
    """(mart, key, key2, Count) of every grouping of a table, one after the other."""
    parts = []
    for name, keys in sets.items():
        cols = [f"CAST({k} AS VARCHAR)" for k in keys] + ["CAST(NULL AS VARCHAR)"] * (2 - len(keys))
        where = " AND ".join(f"{k} IS NOT NULL" for k in keys) or "true"
        group = f" GROUP BY {', '.join(keys)}" if keys else ""
        parts.append(f"SELECT '{name}' AS mart, {cols[0]} AS key, {cols[1]} AS key2, count(*) AS Count FROM {table} WHERE {where}{group}")
    return " UNION ALL ".join(parts)


SQL = {
    "mart_counts_rfm": rfm(all_counts("rfm", {"all": (), "segment": ("Segment",), "score": ("RFM_Score",)})),
    "mart_counts_content": content(all_counts("profile", {
        "all": (), "most_watch": ("MostWatch",), "active": ("Active",), "taste": ("Taste",), "most_watch_active": ("MostWatch", "Active"),
        "devices": ("Total_Devices",)})),
    "mart_counts_search": search(all_counts("search_result", {
        "all": (), "t6": ("Genre_T6",), "t7": ("Genre_T7",), "pair": ("Genre_T6", "Genre_T7"), "keyword_t6": ("Most_Searched_T6",),
        "keyword_t7": ("Most_Searched_T7",), "changing": ("Changing",)})),
    "mart_rfm_filtered": rfm(f"SELECT * FROM rfm WHERE Segment IN ({RFM_SEGMENTS})"),
    "mart_rfm_kpis": rfm(f"""SELECT count(*) AS customers,
  avg(Recency) AS avg_recency, avg(Frequency) AS avg_frequency,
  {ratio(f"sum({cents('Monetary')})", 'count(Monetary) * 100')} AS avg_monetary, avg(CAST(AOV AS BIGINT)) AS avg_aov
FROM rfm"""),
    "mart_rfm_segment_counts": rfm(vc("rfm", "Segment")),
    "mart_rfm_segment_revenue": rfm(f"""SELECT Segment, CAST(sum({cents('Monetary')}) AS DOUBLE) / 100.0 AS Revenue
FROM rfm WHERE Segment IS NOT NULL GROUP BY Segment"""),
    "mart_rfm_segment_share": rfm(share(vc("rfm", "Segment"), "Segment")),
    "mart_top_rfm_scores": rfm(top("rfm", "RFM_Score", 20)),
    "mart_rfm_segment_stats": rfm(f"""SELECT Segment, count(CustomerID) AS Customers,
  {half_even1('sum(Recency)', 'count(Recency)')} AS Avg_Recency,
  {half_even1('sum(Frequency)', 'count(Frequency)')} AS Avg_Frequency,
  {half_even1(f"sum({cents('Monetary')})", 'count(Monetary) * 100')} AS Avg_Monetary,
  {half_even1('sum(CAST(AOV AS BIGINT))', 'count(AOV)')} AS Avg_AOV,
  {half_even1(f"sum({cents('Monetary')})", '100')} AS Total_Revenue
FROM rfm WHERE Segment IS NOT NULL GROUP BY Segment"""),
    "mart_content_filtered": content("""SELECT * FROM profile
WHERE MostWatch IN ('Truyền Hình', 'Phim Truyện', 'Thể Thao') AND Active IN ('Low')"""),
    "mart_content_kpis": content(f"""SELECT count(*) AS users,
  coalesce({ratio("count(*) FILTER (WHERE Active = 'High') * 100", 'count(*)')}, 0.0) AS high_pct,
  coalesce(avg(Total_Devices), 0.0) AS avg_devices,
  CAST({_TOTAL_DURATION} AS BIGINT) AS total_duration
FROM profile"""),
    "mart_content_durations": content(_DURATIONS),
    "mart_content_most_watch": content(vc("profile", "MostWatch")),
    "mart_content_active": content(share(vc("profile", "Active"), "Active")),
    "mart_top_taste15": content(top("profile", "Taste", 15)),
    "mart_content_avg_durations": content(_AVG_DURATIONS),
    "mart_device_histogram": with_ctes(CONTENT_CTES, "").rstrip() + _HISTOGRAM,
    "mart_most_watch_active": content("""SELECT MostWatch, Active, count(*) AS Count FROM profile
WHERE MostWatch IS NOT NULL AND Active IS NOT NULL GROUP BY MostWatch, Active"""),
    "mart_top_taste20": content(top("profile", "Taste", 20)),
    "mart_most_watch_stats": content(f"""SELECT MostWatch, count(Contract) AS Users,
  {half_even1('sum(Total_Devices)', 'count(Total_Devices)')} AS Avg_Devices, {_MW_MEANS},
  {half_even1("count(*) FILTER (WHERE Active = 'High') * 100", 'count(*)')} AS High_Pct
FROM profile WHERE MostWatch IS NOT NULL GROUP BY MostWatch"""),
    "mart_search_filtered": search("""SELECT * FROM search_result
WHERE Genre_T6 IN ('Action', 'Drama', 'Romance', 'Sports', 'Comedy') AND Genre_T7 IN ('Action', 'Drama', 'Romance', 'Music', 'Other')"""),
    "mart_search_changed": search("SELECT * FROM search_result WHERE Changing IS DISTINCT FROM 'No Change'"),
    "mart_search_kpis": search(f"""SELECT count(*) AS users, count(DISTINCT Genre_T6) AS genres_t6,
  count(DISTINCT Genre_T7) AS genres_t7,
  coalesce({ratio("count(*) FILTER (WHERE Changing = 'No Change') * 100", 'count(*)')}, 0.0) AS no_change_pct
FROM search_result"""),
    "mart_genre_t6": search("SELECT Genre_T6 AS Genre, count(*) AS Count FROM search_result "
                            "WHERE Genre_T6 IS NOT NULL GROUP BY Genre_T6"),
    "mart_genre_t7": search("SELECT Genre_T7 AS Genre, count(*) AS Count FROM search_result "
                            "WHERE Genre_T7 IS NOT NULL GROUP BY Genre_T7"),
    "mart_genre_compare": search("""SELECT Genre, count(*) FILTER (WHERE side = 1) AS T6,
  count(*) FILTER (WHERE side = 2) AS T7
FROM (SELECT 1 AS side, Genre_T6 AS Genre FROM search_result UNION ALL SELECT 2, Genre_T7 FROM search_result)
WHERE Genre IS NOT NULL GROUP BY Genre"""),
    "mart_change_status": search(share("""SELECT Status, count(*) AS Count FROM (
  SELECT CASE WHEN Changing IS NOT DISTINCT FROM 'No Change' THEN 'Unchanged' ELSE 'Changed' END AS Status
  FROM search_result) GROUP BY Status""", "Status")),
    "mart_top_changing": search(top("search_result", "Changing", 15)),
    "mart_top_keywords_t6": search("""SELECT Most_Searched_T6 AS Keyword, count(*) AS Count FROM search_result
WHERE Most_Searched_T6 IS NOT NULL GROUP BY Most_Searched_T6 ORDER BY Count DESC, Keyword ASC LIMIT 15"""),
    "mart_top_keywords_t7": search("""SELECT Most_Searched_T7 AS Keyword, count(*) AS Count FROM search_result
WHERE Most_Searched_T7 IS NOT NULL GROUP BY Most_Searched_T7 ORDER BY Count DESC, Keyword ASC LIMIT 15"""),
    "mart_genre_matrix": search(_PAIRS),
    "mart_genre_matrix_wide": search(f"SELECT Genre_T6, {_WIDE} FROM ({_PAIRS}) GROUP BY Genre_T6"),
    "mart_genre_flow": search(f"""SELECT Genre_T6, Genre_T7, Count AS count FROM ({_PAIRS})
ORDER BY Count DESC, Genre_T6, Genre_T7 LIMIT 20"""),
    "mart_genre_flow_nodes": with_ctes(SEARCH_CTES, "").rstrip() + _FLOWS + "SELECT node_index, label FROM nodes",
    "mart_genre_flow_links": with_ctes(SEARCH_CTES, "").rstrip() + _FLOWS + """SELECT s.node_index AS source,
  t.node_index AS target, f.count AS value
FROM flows f JOIN nodes s ON s.label = f.Genre_T6 || ' (T6)' JOIN nodes t ON t.label = f.Genre_T7 || ' (T7)'""",
    "mart_filter_options": with_ctes(RFM_CTES + CONTENT_CTES + SEARCH_CTES, """
SELECT DISTINCT 'Segment' AS filter, Segment AS value FROM rfm WHERE Segment IS NOT NULL
UNION ALL SELECT DISTINCT 'MostWatch', MostWatch FROM profile WHERE MostWatch IS NOT NULL
UNION ALL SELECT DISTINCT 'Active', Active FROM profile WHERE Active IS NOT NULL
UNION ALL SELECT DISTINCT 'Genre_T6', Genre_T6 FROM search_result WHERE Genre_T6 IS NOT NULL
UNION ALL SELECT DISTINCT 'Genre_T7', Genre_T7 FROM search_result WHERE Genre_T7 IS NOT NULL"""),
}
