"""Cleaning, time and bucket functions on the FIXTURES edge frames."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from nearcast.functions import buckets as B
from nearcast.functions import cleaning as C
from nearcast.functions import timeutil as TU
from nearcast.functions.keys import surrogate_key


def col_values(df, c):
    return [r[c] for r in df.orderBy("i").collect()]


def test_clean_text(spark):
    df = spark.createDataFrame([(0, " AA "), (1, ""), (2, "M"), (3, None)], "i int, x string")
    assert col_values(df.select("i", C.clean_text("x").alias("y")), "y") == ["AA", None, None, None]


def test_clean_numeric_and_trace(spark):
    df = spark.createDataFrame([(0, " 1.5 "), (1, ""), (2, "M"), (3, "T")], "i int, x string")
    out = df.select("i", C.clean_numeric_trace("x").cast("double").alias("y"))
    assert col_values(out, "y") == [1.5, None, None, 0.0]
    ok = df.filter("i < 3").select("i", C.clean_numeric("x").cast("double").alias("y"))
    assert col_values(ok, "y") == [1.5, None, None]
    with pytest.raises(Exception):
        df.select(C.clean_numeric("x")).collect()        # 'T' is bad text without trace
    lenient = df.select("i", C.clean_numeric("x", strict=False).cast("double").alias("y"))
    assert col_values(lenient, "y") == [1.5, None, None, None]
    bad = spark.createDataFrame([(0, "x"), (1, "2")], "i int, x string")
    assert [r["i"] for r in C.numeric_violations(bad, ["x"]).collect()] == [0]


def test_flags_and_cancel_aware(spark):
    df = spark.createDataFrame([(0, "1.00"), (1, "0"), (2, ""), (3, None)], "i int, x string")
    assert col_values(df.select("i", C.clean_flag("x").alias("y")), "y") == [True, False, False, False]
    d = spark.createDataFrame([(0, True, ""), (1, False, ""), (2, False, "1.00")], "i int, c boolean, x string")
    out = d.select("i", C.cancel_aware_flag("x", F.col("c")).alias("y"))
    assert col_values(out, "y") == [None, False, True]


HHMM = [("800", "08:00"), ("1530", "15:30"), ("1", "00:01"), ("2400", "next"), (None, None),
        ("", None), ("NA", None), ("930", "09:30"), ("745", "07:45"), ("1200", "12:00"),
        ("800.0", "08:00"), ("2430", None), ("1260", None), ("2500", None)]


def test_hhmm_to_local(spark):
    rows = [(i, date(2025, 1, 15), t) for i, (t, _) in enumerate(HHMM)]
    df = spark.createDataFrame(rows, "i int, d date, t string")
    got = col_values(df.select("i", TU.hhmm_to_local("d", "t").alias("y")), "y")
    for (t, exp), g in zip(HHMM, got):
        if exp is None:
            assert g is None, t
        elif exp == "next":
            assert g == datetime(2025, 1, 16, 0, 0), t
        else:
            h, mi = map(int, exp.split(":"))
            assert g == datetime(2025, 1, 15, h, mi), t


def test_local_to_utc_with_fall_back_fix(spark):
    rows = [(0, datetime(2025, 1, 15, 8, 0), "America/New_York"),
            (1, datetime(2025, 11, 2, 1, 30), "America/New_York"),   # ambiguous: standard time
            (2, datetime(2025, 3, 9, 2, 30), "America/New_York"),    # spring gap
            (3, datetime(2025, 7, 1, 8, 0), "America/Phoenix"),
            (4, datetime(2025, 7, 1, 8, 0), "Pacific/Honolulu")]
    df = spark.createDataFrame(rows, "i int, t timestamp, z string")
    got = col_values(df.select("i", TU.local_to_utc("t", "z").alias("u")), "u")
    assert got == [datetime(2025, 1, 15, 13, 0), datetime(2025, 11, 2, 6, 30),
                   datetime(2025, 3, 9, 7, 30), datetime(2025, 7, 1, 15, 0),
                   datetime(2025, 7, 1, 18, 0)]
    rt = col_values(df.select("i", TU.utc_to_local(TU.local_to_utc("t", "z"), "z").alias("r")), "r")
    assert rt[0] == datetime(2025, 1, 15, 8, 0) and rt[1] == datetime(2025, 11, 2, 1, 30)


def test_month_edge_stays_in_local_month(spark):
    df = spark.createDataFrame([(0, date(2025, 1, 31), "2000")], "i int, d date, t string")
    u = df.select(TU.hhmm_to_utc("d", "t", "America/New_York").alias("u")).first()["u"]
    assert u == datetime(2025, 2, 1, 1, 0)       # UTC month differs; local date keeps January (K1)


def test_calendar_and_months():
    assert TU.month_range("2024-11", "2025-02") == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert TU.month_bounds("2024-12") == ("2024-12-01", "2025-01-01")


def test_iso_weekday(spark):
    df = spark.createDataFrame([(0, datetime(2025, 1, 13)), (1, datetime(2025, 1, 19))], "i int, t timestamp")
    out = df.select("i", TU.calendar_features("t")["dow_iso"].alias("d"))
    assert col_values(out, "d") == [1, 7]


def test_buckets(spark):
    wind = [None, 5, 5.5, 15, 25, 26]
    df = spark.createDataFrame([(i, float(v) if v is not None else None) for i, v in enumerate(wind)], "i int, x double")
    assert col_values(df.select("i", B.wind_bucket("x").alias("b")), "b") == [
        "unknown", "calm_0_5kt", "light_6_15kt", "light_6_15kt", "moderate_16_25kt", "strong_26plus_kt"]
    precip = [None, 0, 0.1, 0.3, 0.31]
    df = spark.createDataFrame([(i, float(v) if v is not None else None) for i, v in enumerate(precip)], "i int, x double")
    assert col_values(df.select("i", B.precip_bucket("x").alias("b")), "b") == [
        "none", "none", "light", "moderate", "heavy"]
    vis = [None, 2.9, 3, 10, 10.1]
    df = spark.createDataFrame([(i, float(v) if v is not None else None) for i, v in enumerate(vis)], "i int, x double")
    assert col_values(df.select("i", B.visibility_bucket("x").alias("b")), "b") == [
        "unknown", "low_under_3mi", "medium_3_10mi", "medium_3_10mi", "high_over_10mi"]
    lags = [60, 30, 10, 0.5, 0, -10, -30, -60, -61]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(lags)], "i int, x double")
    assert col_values(df.select("i", B.lag_bucket("x").alias("b")), "b") == B.LAG_LABELS


def test_order_key_unknown_after(spark):
    df = spark.createDataFrame([(0, "heavy"), (1, "none"), (2, "zzz")], "i int, b string")
    got = col_values(df.select("i", B.order_key("b", B.PRECIP_LABELS).alias("o")), "o")
    assert got == [4, 1, 5]


def test_surrogate_key_matches_md5(spark):
    import hashlib
    df = spark.createDataFrame([(0, "AA", None, "JFK")], "i int, a string, b string, c string")
    got = df.select(surrogate_key("a", "b", "c").alias("k")).first()["k"]
    assert got == hashlib.md5(b"AA||JFK").hexdigest()
