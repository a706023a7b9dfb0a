"""Explicit schemas, canonical column names and fixed label values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# App code -> viewing category, in the reference's rule order. Matching is
# case-sensitive; any other code (and NULL) is dropped.
APP_CATEGORIES: dict[str, list[str]] = {
    "Truyền Hình": ["CHANNEL", "DSHD", "KPLUS", "KPlus"],
    "Phim Truyện": ["VOD", "FIMS_RES", "BHD_RES", "VOD_RES", "FIMS", "BHD", "DANET"],
    "Giải Trí": ["RELAX"],
    "Thiếu Nhi": ["CHILD"],
    "Thể Thao": ["SPORT"],
}

# Category label -> output column of the content profile.
CATEGORY_COLUMNS: dict[str, str] = {
    "Giải Trí": "Total_Giai_Tri",
    "Phim Truyện": "Total_Phim_Truyen",
    "Thể Thao": "Total_The_Thao",
    "Thiếu Nhi": "Total_Thieu_Nhi",
    "Truyền Hình": "Total_Truyen_Hinh",
}

# Most-watched tie priority (first wins).
MOST_WATCH_PRIORITY: list[str] = ["Truyền Hình", "Phim Truyện", "Thể Thao", "Thiếu Nhi", "Giải Trí"]

# Order of categories inside the Taste string, joined with "-".
TASTE_ORDER: list[str] = ["Giải Trí", "Phim Truyện", "Thể Thao", "Thiếu Nhi", "Truyền Hình"]

# Dashboard order of the duration columns and their labels.
DASHBOARD_CATEGORY_ORDER: list[str] = ["Truyền Hình", "Phim Truyện", "Giải Trí", "Thể Thao", "Thiếu Nhi"]

# Active days strictly above this -> "High", else "Low".
ACTIVE_DAYS_THRESHOLD = 4

# Placeholder contract dropped from every content aggregate.
PLACEHOLDER_CONTRACT = "0"

# Search change labels.
NO_CHANGE = "No Change"
CHANGE_ARROW = " -> "

# Closed genre label set of keyword classification.
GENRES: list[str] = [
    "Action", "Romance", "Comedy", "Horror", "Animation", "Drama", "C Drama",
    "K Drama", "Sports", "Music", "Reality Show", "TV Channel", "News", "Other",
]
DEFAULT_GENRE = "Other"

# Keyword hint rules, in order: any listed word (case-insensitive substring)
# gives the genre.
GENRE_HINTS: list[tuple[str, list[str]]] = [
    ("TV Channel", ["vtv", "htv", "channel"]),
    ("Reality Show", ["running", "master key", "reality"]),
    ("Romance", ["sex", "romantic", "love"]),
    ("Drama", ["potter", "hogwarts"]),
    ("Drama", ["phim việt"]),
    ("C Drama", ["phim trung"]),
    ("K Drama", ["phim hàn"]),
]

# Worked examples of keyword -> genre; the default override table.
GENRE_EXAMPLES: dict[str, str] = {
    "thuyếtminh": "Other",
    "bigfoot": "Horror",
    "capdoi": "Romance",
    "ARGEN": "Sports",
    "nhật ký": "Drama",
    "PENT": "C Drama",
    "running": "Reality Show",
    "VTV3": "TV Channel",
}

# RFM: number of tiles, and segment rules in order; first match wins, else
# "Lost". Each rule: (segment, R condition, FM condition) as (lo, hi) bounds, None is open.
RFM_TILES = 5
RFM_SEGMENT_RULES: list[tuple[str, tuple[int | None, int | None], tuple[int | None, int | None]]] = [
    ("Champions", (4, None), (4, None)),
    ("Loyal Customers", (3, None), (4, None)),
    ("Potential Loyalist", (4, None), (2, 3)),
    ("Recent Customers", (4, None), (None, 1)),
    ("Promising", (3, 3), (None, 1)),
    ("Need Attention", (3, 3), (2, 3)),
    ("About to Sleep", (2, 2), (1, 2)),
    ("At Risk", (2, 2), (3, None)),
    ("Can't Lose Them", (1, 1), (4, None)),
    ("Hibernating", (1, 1), (2, 3)),
]
RFM_DEFAULT_SEGMENT = "Lost"

# Default period labels of the search change table.
PERIOD_LABELS: tuple[str, str] = ("T6", "T7")

# ---------------------------------------------------------------------------
# Input schemas
# ---------------------------------------------------------------------------

CONTENT_SOURCE = T.StructType([
    T.StructField("Contract", T.StringType()),
    T.StructField("Mac", T.StringType()),
    T.StructField("AppName", T.StringType()),
    T.StructField("TotalDuration", T.LongType()),
])

# One JSON line of the viewing log; other outer fields are ignored.
CONTENT_LOG_JSON = T.StructType([T.StructField("_source", CONTENT_SOURCE)])

# Flat viewing log as every content operator consumes it.
CONTENT_FLAT = T.StructType(CONTENT_SOURCE.fields + [T.StructField("Process_Date", T.DateType())])

SEARCH_LOG = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("keyword", T.StringType()),
])

MOST_SEARCH = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("search_count", T.LongType()),
])

SEARCH_CATEGORY = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("search_count", T.LongType()),
    T.StructField("Genre", T.StringType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("Transaction_ID", T.StringType()),
    T.StructField("CustomerID", T.LongType()),
    T.StructField("Purchase_Date", T.DateType()),
    T.StructField("GMV", T.DecimalType(18, 2)),
])

# ---------------------------------------------------------------------------
# Output column lists
# ---------------------------------------------------------------------------

CONTENT_PROFILE_COLUMNS = [
    "Contract", "Total_Devices", "Total_Giai_Tri", "Total_Phim_Truyen", "Total_The_Thao",
    "Total_Thieu_Nhi", "Total_Truyen_Hinh", "MostWatch", "Taste", "Active",
]
SEARCH_CHANGE_COLUMNS = [
    "user_id", "Most_Searched_T6", "Genre_T6", "Most_Searched_T7", "Genre_T7", "Changing",
]
RFM_COLUMNS = ["CustomerID", "Recency", "Frequency", "Monetary", "AOV", "RFM_Score", "Segment"]


# Result table types (as the pipelines write them).
RESULT_TYPES: dict[str, dict[str, str]] = {
    "rfm": {"CustomerID": "bigint", "Recency": "int", "Frequency": "bigint", "Monetary": "double",
            "AOV": "double", "RFM_Score": "string", "Segment": "string"},
    "content": {"Contract": "string", "Total_Devices": "bigint", "Total_Giai_Tri": "bigint",
                "Total_Phim_Truyen": "bigint", "Total_The_Thao": "bigint", "Total_Thieu_Nhi": "bigint",
                "Total_Truyen_Hinh": "bigint", "MostWatch": "string", "Taste": "string", "Active": "string"},
    "search": {c: "string" for c in SEARCH_CHANGE_COLUMNS},
}


def duration_columns() -> list[str]:
    """The five per-category duration columns in TASTE_ORDER."""
    return [CATEGORY_COLUMNS[c] for c in TASTE_ORDER]
