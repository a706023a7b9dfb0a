import datetime as dt

from pyspark.sql import functions as F

from viewlens import schemas as S
from viewlens.operators import content as C
from viewlens.plans.content import content_daily, content_table

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def flat(spark, data):
    return spark.createDataFrame(data, S.CONTENT_FLAT)


def test_categorise_case_sensitive_and_drops(spark):
    df = flat(spark, [("A", "m", app, 1, D1) for app in ["KPLUS", "KPlus", "kplus", "DANET", None, "X"]])
    got = [r.Type for r in C.categorize(df).orderBy("AppName").collect()]
    assert sorted(got) == sorted(["Truyền Hình", "Truyền Hình", "Phim Truyện"])


def test_placeholder_contract(spark):
    df = flat(spark, [(c, "m", "KPLUS", 1, D1) for c in ["0", None, "A"]])
    assert [r.Contract for r in C.valid_views(df).collect()] == ["A"]


def test_devices_distinct_ignores_null(spark):
    df = flat(spark, [("A", m, "KPLUS", 1, D1) for m in ["m1", "m1", "m2", None]])
    assert C.daily_devices(C.valid_views(df)).collect()[0].Total_Devices == 2


def test_pivot_fill_zero(spark):
    df = flat(spark, [("A", "m", "SPORT", 5, D1)])
    r = C.daily_pivot(C.valid_views(df)).collect()[0]
    assert r.Total_The_Thao == 5
    assert r.Total_Giai_Tri == r.Total_Phim_Truyen == r.Total_Thieu_Nhi == r.Total_Truyen_Hinh == 0


def _labels(spark, d):
    cols = S.duration_columns()
    row = tuple(d.get(c, 0) for c in cols)
    df = spark.createDataFrame([row], ", ".join(f"{c} bigint" for c in cols))
    return C.with_labels(df).collect()[0]


def test_most_watch_tie_priority(spark):
    r = _labels(spark, {"Total_Giai_Tri": 5, "Total_The_Thao": 5})
    assert r.MostWatch == "Thể Thao"


def test_all_zero_labels(spark):
    r = _labels(spark, {})
    assert r.MostWatch == "Truyền Hình" and r.Taste == ""


def test_taste_order(spark):
    r = _labels(spark, {"Total_Giai_Tri": 1, "Total_Truyen_Hinh": 2})
    assert r.Taste == "Giải Trí-Truyền Hình"


def test_activity_threshold(spark):
    data = [("A", "m", "KPLUS", 1, dt.date(2024, 1, d)) for d in range(1, 5)]
    data += [("B", "m", "KPLUS", 1, dt.date(2024, 1, d)) for d in range(1, 6)]
    got = {r.Contract: r.Active for r in content_table(flat(spark, data)).collect()}
    assert got == {"A": "Low", "B": "High"}


def test_period_label_first_day_vs_period(spark):
    data = [("A", "m", "SPORT", 10, D1), ("A", "m", "KPLUS", 50, D2)]
    f = flat(spark, data)
    assert content_table(f).collect()[0].MostWatch == "Thể Thao"
    assert content_table(f, labels="period").collect()[0].MostWatch == "Truyền Hình"


def test_device_total_sum_vs_distinct(spark):
    data = [("A", "m1", "KPLUS", 1, D1), ("A", "m1", "KPLUS", 1, D2)]
    f = flat(spark, data)
    assert content_table(f).collect()[0].Total_Devices == 2
    assert C.distinct_devices(C.valid_views(f)).collect()[0].Distinct_Devices == 1


def test_daily_single_aggregate_equals_join_shape(spark):
    """The one-aggregate daily profile equals devices ⋈ pivot (the reference's shape)."""
    from viewlens.sources import testdata as TD
    f = TD.content_log(spark, "/root/testdata/sf0.001")
    v = C.valid_views(f)
    joined = C.daily_pivot(v).join(C.daily_devices(v), C.DAY_KEYS)
    one = C.daily_profile(v)
    cols = one.columns
    assert sorted(map(tuple, joined.select(cols).collect())) == sorted(map(tuple, one.collect()))


def test_empty_input_gives_empty_table(spark):
    out = content_table(flat(spark, []))
    assert out.count() == 0 and out.columns == S.CONTENT_PROFILE_COLUMNS
    assert content_daily(flat(spark, [])).count() == 0
