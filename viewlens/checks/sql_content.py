"""SQL of the content queries (DuckDB dialect)."""

from viewlens.checks.sql_rfm import with_ctes


def flat(where: str = "") -> str:
    return f"""flat AS (
  SELECT CAST(user_id AS VARCHAR) AS Contract, json_extract_string(props, '$.k') AS Mac,
         CASE WHEN event_type = 'purchase' THEN (CASE WHEN event_id % 2 = 0 THEN 'RELAX' ELSE 'CHILD' END)
              WHEN event_type = 'view' THEN 'KPLUS' WHEN event_type = 'click' THEN 'VOD'
              WHEN event_type = 'signup' THEN 'SPORT' WHEN event_type = 'error' THEN 'UNKNOWN_APP' END AS AppName,
         CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS TotalDuration,
         CAST(ts AS DATE) AS Process_Date
  FROM events {where})"""


RANGE_WHERE = "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-06'"

CAT = """cat AS (
  SELECT *, CASE WHEN AppName IN ('CHANNEL', 'DSHD', 'KPLUS', 'KPlus') THEN 'Truyền Hình'
                 WHEN AppName IN ('VOD', 'FIMS_RES', 'BHD_RES', 'VOD_RES', 'FIMS', 'BHD', 'DANET') THEN 'Phim Truyện'
                 WHEN AppName = 'RELAX' THEN 'Giải Trí'
                 WHEN AppName = 'CHILD' THEN 'Thiếu Nhi'
                 WHEN AppName = 'SPORT' THEN 'Thể Thao' END AS Type
  FROM flat)"""

VALID = """valid AS (SELECT * FROM cat WHERE Type IS NOT NULL AND Contract <> '0')"""

DUR = [("Giải Trí", "Total_Giai_Tri"), ("Phim Truyện", "Total_Phim_Truyen"), ("Thể Thao", "Total_The_Thao"),
       ("Thiếu Nhi", "Total_Thieu_Nhi"), ("Truyền Hình", "Total_Truyen_Hinh")]
DUR_COLS = ", ".join(c for _, c in DUR)
DUR_SUMS = ",\n         ".join(
    f"CAST(coalesce(sum(CASE WHEN Type = '{t}' THEN TotalDuration END), 0) AS BIGINT) AS {c}" for t, c in DUR)

DAILY = f"""daily AS (
  SELECT Contract, Process_Date, count(DISTINCT Mac) AS Total_Devices,
         {DUR_SUMS}
  FROM valid GROUP BY Contract, Process_Date)"""

PIVOT = f"""pivot_daily AS (
  SELECT Contract, Process_Date,
         {DUR_SUMS}
  FROM valid GROUP BY Contract, Process_Date)"""


def labels_of(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *,
    CASE WHEN greatest(Total_Giai_Tri, Total_Phim_Truyen, Total_The_Thao, Total_Thieu_Nhi, Total_Truyen_Hinh) = Total_Truyen_Hinh THEN 'Truyền Hình'
         WHEN greatest(Total_Giai_Tri, Total_Phim_Truyen, Total_The_Thao, Total_Thieu_Nhi, Total_Truyen_Hinh) = Total_Phim_Truyen THEN 'Phim Truyện'
         WHEN greatest(Total_Giai_Tri, Total_Phim_Truyen, Total_The_Thao, Total_Thieu_Nhi, Total_Truyen_Hinh) = Total_The_Thao THEN 'Thể Thao'
         WHEN greatest(Total_Giai_Tri, Total_Phim_Truyen, Total_The_Thao, Total_Thieu_Nhi, Total_Truyen_Hinh) = Total_Thieu_Nhi THEN 'Thiếu Nhi'
         WHEN greatest(Total_Giai_Tri, Total_Phim_Truyen, Total_The_Thao, Total_Thieu_Nhi, Total_Truyen_Hinh) = Total_Giai_Tri THEN 'Giải Trí' END AS MostWatch,
    concat_ws('-', CASE WHEN Total_Giai_Tri > 0 THEN 'Giải Trí' END, CASE WHEN Total_Phim_Truyen > 0 THEN 'Phim Truyện' END,
              CASE WHEN Total_The_Thao > 0 THEN 'Thể Thao' END, CASE WHEN Total_Thieu_Nhi > 0 THEN 'Thiếu Nhi' END,
              CASE WHEN Total_Truyen_Hinh > 0 THEN 'Truyền Hình' END) AS Taste
  FROM {src})"""


LABELED = labels_of("daily", "labeled")

PERIOD_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for _, c in DUR)

def profile(threshold: int = 4) -> str:
    return f"""profile AS (
  SELECT Contract, CAST(sum(Total_Devices) AS BIGINT) AS Total_Devices, {PERIOD_SUMS},
         arg_min(MostWatch, Process_Date) AS MostWatch, arg_min(Taste, Process_Date) AS Taste,
         CASE WHEN count(*) > {threshold} THEN 'High' ELSE 'Low' END AS Active
  FROM labeled GROUP BY Contract)"""

PERIOD_TOTALS = f"""period_totals AS (
  SELECT Contract, CAST(sum(Total_Devices) AS BIGINT) AS Total_Devices, {PERIOD_SUMS},
         CASE WHEN count(*) > 4 THEN 'High' ELSE 'Low' END AS Active
  FROM daily GROUP BY Contract)"""

PROFILE_COLS = f"Contract, Total_Devices, {DUR_COLS}, MostWatch, Taste, Active"


def content_ctes(where: str = "", threshold: int = 4) -> list[str]:
    return [flat(where), CAT, VALID, DAILY, LABELED, profile(threshold)]


CONTENT_CTES = content_ctes()

ISO = "strftime(Process_Date, '%Y-%m-%d') AS Process_Date"

DISTINCT_DEVICES = "SELECT Contract, count(DISTINCT Mac) AS Distinct_Devices FROM valid GROUP BY Contract"

SQL = {
    "content_categorize": with_ctes([flat(), CAT], f"""
SELECT Contract, Mac, AppName, TotalDuration, {ISO}, Type FROM cat WHERE Type IS NOT NULL"""),
    "content_daily_devices": with_ctes([flat(), CAT, VALID], f"""
SELECT Contract, {ISO}, count(DISTINCT Mac) AS Total_Devices FROM valid GROUP BY Contract, Process_Date"""),
    "content_daily_durations": with_ctes([flat(), CAT, VALID], f"""
SELECT Contract, {ISO}, Type, CAST(sum(TotalDuration) AS BIGINT) AS Total_Duration
FROM valid GROUP BY Contract, Process_Date, Type"""),
    "content_daily_pivot": with_ctes([flat(), CAT, VALID, PIVOT], f"""
SELECT Contract, {ISO}, {DUR_COLS} FROM pivot_daily"""),
    "content_daily_profile": with_ctes([flat(), CAT, VALID, DAILY], f"""
SELECT Contract, {ISO}, Total_Devices, {DUR_COLS} FROM daily"""),
    "content_most_watch": with_ctes([flat(), CAT, VALID, DAILY, LABELED], f"""
SELECT Contract, {ISO}, {DUR_COLS}, MostWatch FROM labeled"""),
    "content_taste": with_ctes([flat(), CAT, VALID, DAILY, LABELED], f"""
SELECT Contract, {ISO}, {DUR_COLS}, Taste FROM labeled"""),
    "content_activity": with_ctes([flat(), CAT, VALID], """
SELECT Contract, count(DISTINCT Process_Date) AS Active_Days,
       CASE WHEN count(DISTINCT Process_Date) > 4 THEN 'High' ELSE 'Low' END AS Active
FROM valid GROUP BY Contract"""),
    "content_profile": with_ctes(CONTENT_CTES, f"SELECT {PROFILE_COLS} FROM profile"),
    "content_profile_from_stream": with_ctes(CONTENT_CTES, f"SELECT {PROFILE_COLS} FROM profile"),
    "content_from_json": with_ctes(CONTENT_CTES, f"SELECT {PROFILE_COLS} FROM profile"),
    "content_profile_range": with_ctes(content_ctes(RANGE_WHERE), f"SELECT {PROFILE_COLS} FROM profile"),
    "content_profile_period": with_ctes(
        [flat(), CAT, VALID, DAILY, PERIOD_TOTALS, labels_of("period_totals", "period_labeled")],
        f"SELECT {PROFILE_COLS} FROM period_labeled"),
    **dict.fromkeys(("content_distinct_devices", "content_devices_from_days"), with_ctes([flat(), CAT, VALID], DISTINCT_DEVICES)),
    "content_devices_of_range": with_ctes([flat(RANGE_WHERE), CAT, VALID], DISTINCT_DEVICES),
    "content_published": with_ctes(content_ctes("", 26), f"SELECT {PROFILE_COLS} FROM profile"),
    "content_profile_quarantined": with_ctes(content_ctes("WHERE event_id % 50 NOT IN (7, 8, 9)"), f"SELECT {PROFILE_COLS} FROM profile"),
    "content_quarantine": """
SELECT strftime(ts, '%Y-%m-%d') AS Process_Date, CASE event_id % 50 WHEN 8 THEN 'no _source' ELSE 'does not parse' END AS reason,
  CASE event_id % 50
    WHEN 7 THEN '{"_source": {"Contract": "' || coalesce(CAST(user_id AS VARCHAR), '') || '", "event": ' || event_id
    WHEN 8 THEN '{"_other": {"event": ' || event_id || '}}'
    ELSE '{"_source": {"Contract": "' || coalesce(CAST(user_id AS VARCHAR), '') || '", "TotalDuration": "much ' || event_id || '"}}' END AS line
FROM events WHERE event_id % 50 IN (7, 8, 9)""",
    "content_daily_files": with_ctes([flat()], f"""
SELECT Contract, Mac, AppName, TotalDuration, {ISO} FROM flat"""),
    "content_range_scan": with_ctes([flat(RANGE_WHERE)], f"""
SELECT Contract, Mac, AppName, TotalDuration, {ISO} FROM flat"""),
    **dict.fromkeys(("content_daily_stream", "content_daily_refreshed"), with_ctes([flat(), CAT, VALID, DAILY, LABELED], f"""
SELECT Contract, {ISO}, Total_Devices, {DUR_COLS}, MostWatch, Taste FROM labeled""")),
}
