"""Texts as the contract reads them, held against Python's own strip, int, float and strptime."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tollgate.functions import text

VALUES = ["", " ", "NA", "N/A", "null", "NULL", "None", "none", " NA ", "0", "-1", "+7", "1_000", "1__0", "_1", "1_", "3.5", "3.", ".5", ".", "1e5", "1e", "1E-3", "1.5d", "1.5f", "0x1p3", "nan", "-nan", "+NaN", "inf", "-Infinity", "infinit", " 42 ", " 42 ", "\t7\n", "12a", "9" * 40, "1_0.5_0e1_0", "abc", "--1", "1 2", "é"]
TIMES = ["2025-01-01T00:00:00.000", "2025-01-01T00:00:00", "2025-01-01 00:00:00", "2025-01-01", "2025-01-01T00:00:00Z", "2025-1-2T3:4:5", "2025-02-30T00:00:00", "2025-01-01T24:00:00", "2025-01-01T00:00:00.1234567", "2025-01-01T00:00:00.12", " 2025-03-09T02:30:00 ", "", "NA", "2025-13-01T00:00:00", "2025-01-01T00:60:00"]
SHAPES = ("%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S")


def attempt(f, v):
    try:
        return f(v)
    except ValueError:
        return None


def parsed(v):
    return next((t for s in SHAPES if (t := attempt(lambda x, s=s: datetime.strptime(x.strip(), s), v))), None)


@pytest.fixture(scope="module")
def read(spark):
    df = spark.createDataFrame([(v,) for v in [*VALUES, None]], "v string")
    c = F.col("v")
    return {r.v: r for r in df.select("v", text.is_null(c).alias("null"), text.is_integer(c).alias("whole"), text.number(c).alias("number"), F.char_length(text.stripped(c)).alias("n")).collect()}


@pytest.mark.parametrize("v", VALUES)
def test_like_python(read, v):
    assert read[v].null == (v.strip() in ("", "NA", "N/A", "null", "NULL", "None"))
    assert bool(read[v].whole) == (attempt(int, v) is not None)
    got, want = read[v].number, attempt(float, v)
    assert (got is None) == (want is None)
    assert want is None or got == want or (math.isnan(got) and math.isnan(want))
    assert read[v].n == len(v.strip())


def test_null_is_null_and_nothing_else(read):
    assert read[None].null and read[None].number is None and not read[None].whole


def test_timestamps(spark):
    df = spark.createDataFrame([(v,) for v in TIMES], "v string").select("v", text.timestamp(F.col("v")).alias("t"), text.fractional_timestamp(F.col("v")).alias("f"))
    for r in df.collect():
        assert r.t == parsed(r.v), r.v
        assert r.f == attempt(lambda x: datetime.strptime(x, SHAPES[0]), r.v), r.v


def test_patterns_are_anchored_at_the_start_only(spark):
    df = spark.createDataFrame([("10001-22",), (" 10001",), ("x10001",)], "v string")
    assert [r.m for r in df.select(text.starts_matching(F.col("v"), "[0-9]{5}").alias("m")).collect()] == [True, True, False]


def test_hours_count_minute_boundaries(spark):
    df = spark.sql("select timestamp_ntz'2025-01-01 00:00:59' as a, timestamp_ntz'2025-01-01 00:01:00' as b")
    assert df.select(text.hours_between(F.col("a"), F.col("b")).alias("h")).first().h == pytest.approx(1 / 60)


def test_rounding_is_of_the_binary_value(spark):
    df = spark.createDataFrame([(0.575,), (2.5,), (None,)], "v double")
    assert [r.r for r in df.select(text.rounded(F.col("v")).alias("r")).collect()] == [math.floor(0.575 * 100 + 0.5) / 100, 2.5, None]


def test_nothing_depends_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2025-03-09T01:59:59.000", "2025-03-09T02:30:00.000")], "a string, b string")
        a, b = (text.timestamp(F.col(c)) for c in "ab")
        r = df.select(b.cast("string").alias("b"), text.hours_between(a, b).alias("h"), text.exact_hours(a, b).alias("x")).first()
        assert (r.b, r.h) == ("2025-03-09 02:30:00", pytest.approx(31 / 60)) and r.x == pytest.approx(1801 / 3600)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
