"""Hand-written edge rows (FIXTURES.md section 4) through the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from racelake.functions import athlete, dates, distance, performance, speed
from racelake.functions.columns import snake_case_columns


def one(spark, value, expr_fn, schema="x string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr_fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text,start,end", [
    ("07.12.1991", dt.date(1991, 12, 7), dt.date(1991, 12, 7)),
    ("23.-24.11.1991", dt.date(1991, 11, 23), dt.date(1991, 11, 24)),
    ("30.10.-03.11.1991", dt.date(1991, 10, 30), dt.date(1991, 11, 3)),
    ("31.12.-01.01.2018", dt.date(2017, 12, 31), dt.date(2018, 1, 1)),
    ("28.12.2019-03.01.2020", dt.date(2019, 12, 28), dt.date(2020, 1, 3)),
    ("00.06.1991", None, None),
    ("31.02.1991", None, None),
    (None, None, None),
    ("1991-12-07", None, None),
])
def test_event_dates(spark, text, start, end):
    df = spark.createDataFrame([(text,)], "x string")
    s, e = dates.event_date_bounds("x")
    row = df.select(s.alias("s"), e.alias("e"), dates.date_key(s).alias("k")).first()
    assert (row["s"], row["e"]) == (start, end)
    if start is not None:
        assert row["k"] == int(start.strftime("%Y%m%d"))


def test_date_layouts(spark):
    assert one(spark, "07.12.1991", dates.classify_date_format) == "single_date"
    assert one(spark, "23.-24.11.1991", dates.classify_date_format) == "date_range_same_month"
    assert one(spark, None, dates.classify_date_format) == "unknown_format"


@pytest.mark.parametrize("text,kind,std", [
    ("50K", "distance_k_needs_standardization", "50km"),
    (" 45Km", "distance_km", "45km"),
    ("26.2mi", "distance_mi", "26.2mi"),
    ("24h", "time_hours", "24h"),
    ("24.5h", "invalid_or_unknown", None),
    ("71.5", "invalid_or_unknown", None),
    ("10d", "days_invalid", None),
    ("57km/2Etappen", "multi_stage_invalid", None),
    (None, "invalid_or_unknown", None),
])
def test_distance(spark, text, kind, std):
    assert one(spark, text, distance.classify_event_distance) == kind
    if std is not None:
        assert one(spark, text, distance.standardize_distance) == std


@pytest.mark.parametrize("text,kind,seconds,covered", [
    ("8:52:00 h", "time_hours", 31920, None),
    ("13d 14:02:52 h", "time_days_hours", 1173772, None),
    (" 8:52:00 h ", "time_hours", 31920, None),
    ("160.944 km", "distance_km", None, 160.944),
    ("93.2 mi", "distance_mi", None, 93.2),
    ("4:5 h", "unknown", None, None),
    ("999999999:00:00 h", "time_hours", None, None),     # overflow: NULL, not an error
    (None, "null", None, None),
])
def test_performance(spark, text, kind, seconds, covered):
    assert one(spark, text, performance.classify_performance) == kind
    assert one(spark, text, performance.duration_seconds) == seconds
    assert one(spark, text, performance.performance_distance) == covered


@pytest.mark.parametrize("value,unit,secs,cov,cov_unit,expected", [
    (100.0, "km", 3 * 3600 + 32 * 60, None, "seconds", 28.302),
    (48.0, "h", None, 47.153, "km", 0.982),
    (24.0, "h", None, 93.2, "mi", 6.25),
    (100.0, "km", 0, None, "seconds", None),     # zero time: NULL, not an error
])
def test_average_speed(spark, value, unit, secs, cov, cov_unit, expected):
    df = spark.createDataFrame([(value, unit, secs, cov, cov_unit)],
                               "v double, u string, s int, c double, cu string")
    got = df.select(speed.average_speed_kmh("v", "u", "s", "c", "cu").alias("y")).first()["y"]
    assert got == expected


def test_round_half_up(spark):
    # Spark rounds the decimal text of a double: 1.0005 -> 1.001 (binary value is below the tie).
    df = spark.createDataFrame([(1.0005,)], "x double")
    assert df.select(F.round("x", 3)).first()[0] == 1.001


@pytest.mark.parametrize("text,expected", [
    ("***", "unknown"), ("  ", "unknown"), (None, "unknown"), ("* Abc", "Abc"), ("Łódź X", "Łódź X"),
])
def test_clean_club(spark, text, expected):
    assert one(spark, text, athlete.clean_club) == expected


def test_age_rules(spark):
    df = spark.createDataFrame([(2000, 1193.0), (2000, 1996.0), (2000, 1899.0), (2000, 1995.0), (2000, 1900.0)],
                               "y int, b double")
    rows = df.select(athlete.clean_birth_year("b").alias("b")).select(
        athlete.age_at_event(F.lit(2000), "b").alias("a")).collect()
    assert [r["a"] for r in rows] == [None, None, None, 5, 100]


@pytest.mark.parametrize("cat,label,sort", [
    ("MU23", "Under 23", 22), ("W40", "40+", 40), ("U20", "Under 20", 19), ("M", "+", None),
    ("unknown", "unknown", 999),
])
def test_age_group(spark, cat, label, sort):
    df = spark.createDataFrame([(cat,)], "x string")
    lab, srt = athlete.age_group_label("x")
    row = df.select(lab.alias("l"), srt.alias("s")).first()
    assert (row["l"], row["s"]) == (label, sort)


def test_business_age_group(spark):
    assert one(spark, "MU23", athlete.business_age_group) == "Under 23"
    assert one(spark, "M45", athlete.business_age_group) == "45+"
    assert one(spark, "W35", athlete.business_age_group) == "35+"


def test_gender_label(spark):
    assert [one(spark, g, athlete.gender_label) for g in ["M", "F", "X", None]] == \
        ["Male", "Female", "Other / Unknown", "Other / Unknown"]


def test_snake_case(spark):
    df = spark.createDataFrame([(1, 2)], "`Event distance/length` int, ` Year of event ` int")
    assert snake_case_columns(df).columns == ["event_distance_length", "year_of_event"]
    clash = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        snake_case_columns(clash)


def test_speed_quality(spark):
    got = [one(spark, v, speed.speed_quality) for v in [None, "09:29:17", "0.0", "7666.0", "7.5"]]
    assert got == ["raw_null", "malformed_not_numeric", "zero_or_negative", "scaled_above_1000", "valid_numeric"]


def test_impossible_dates_are_null_without_a_failed_parse(spark):
    texts = ["00.08.2004", "30.02.2011", "29.02.2004", "29.02.1900", "31.13.2001", "01.01.0000", "05.04.2003\n",
             "31.-01.04.2005", "30.12.-02.01.2010", "30.12.-02.01.1000", "29.02.2004-30.02.2004", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string").withColumn("layout", dates.classify_date_format("x"))
    by_text, by_layout = dates.event_date_bounds("x"), dates.event_date_bounds("x", layout="layout")
    d = dt.date
    want = [(None, None), (None, None), (d(2004, 2, 29),) * 2, (None, None), (None, None), None, (None, None),
            (None, d(2005, 4, 1)), (d(2009, 12, 30), d(2010, 1, 2)), (None, d(1000, 1, 2)), (d(2004, 2, 29), None),
            (None, None)]
    for start, end in (by_text, by_layout):
        rows = df.select("x", start.cast("string").alias("s"), end.cast("string").alias("e"))
        got = {r.x: (r.s, r.e) for r in rows.collect()}
        for text, w in zip(texts, want):
            if w is not None:  # year 0 is a Spark date, but none of Python's
                assert got[text] == tuple(x and x.isoformat() for x in w), text
        assert got["01.01.0000"] == ("0000-01-01",) * 2
        assert "try_to_date" not in rows._jdf.queryExecution().toString()
