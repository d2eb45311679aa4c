"""Cast fixture (FIXTURES.md section 2) on hand-written values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casetrail.functions import casts

UTC = dt.timezone.utc


def _one(spark, fn, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(fn(F.col("v")).alias("x")).first().x


def _ts(*a):
    return dt.datetime(*a)


@pytest.mark.parametrize("value,expected", [
    ("2026-05-29T12:31:45Z", _ts(2026, 5, 29, 12, 31, 45)),
    ("2026-05-29 12:31:45+00", _ts(2026, 5, 29, 12, 31, 45)),
    ("2026-05-29T14:31:45+02:00", _ts(2026, 5, 29, 12, 31, 45)),
    ("2026-05-29", _ts(2026, 5, 29)),
    ("1716986100000", _ts(2024, 5, 29, 12, 35)),
    ("1716986100", _ts(2024, 5, 29, 12, 35)),
    ("unknown", None), ("not-a-date", None), ("2026-13-45", None), ("null", None),
    ("undefined", None), (None, None), ("", None),
])
def test_safe_timestamp(spark, value, expected):
    assert _one(spark, casts.safe_timestamp, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("3", 3), ("3.0", 3), ("1,200", 1200), (" 2 ", 2), ("+7", 7), ("-4", -4),
    ("", None), ("unknown", None), ("null", None), ("NaN", None), ("n/a", None),
    ("undefined", None), ("99999999999999999999", None), ("1520.5", None), ("1e3", None),
    (None, None),
])
def test_safe_int64(spark, value, expected):
    assert _one(spark, casts.safe_int64, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("1520", 1520.0), ("1520.0", 1520.0), ("1,520", 1520.0), ("1520.5", 1520.5),
    (".5", 0.5), ("1e2", 100.0), ("1e999", None), ("1520d", None), ("n/a", None), (None, None),
])
def test_safe_float64(spark, value, expected):
    assert _one(spark, casts.safe_float64, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("true", True), ("yes", True), ("Y", True), ("1", True), (" t ", True),
    ("false", False), ("0", False), ("no", False), ("N", False),
    ("", None), ("maybe", None), (None, None),
])
def test_safe_boolean(spark, value, expected):
    assert _one(spark, casts.safe_boolean, value) == expected


def test_parse_failed_flags_only_present_values(spark):
    df = spark.createDataFrame([("3",), ("n/a",), (None,), ("1520.5",)], "v string")
    out = df.select(casts.parse_failed(F.col("v"), casts.safe_int64(F.col("v"))).alias("f"))
    assert [r.f for r in out.collect()] == [False, True, False, True]


def test_blank_to_null_trims_spaces_only(spark):
    df = spark.createDataFrame([("  a ",), ("   ",), ("\tb",)], "v string")
    out = [r.x for r in df.select(casts.blank_to_null(F.col("v")).alias("x")).collect()]
    assert out == ["a", None, "\tb"]
