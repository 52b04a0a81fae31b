from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.functions import cleaning as c
from siltstone.functions.timekeys import date_key, time_key
from siltstone.schemas import HOUR_BANDS, OTHER_HOURS, OTHER_SEVERITY, SEVERITY_BANDS


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first()["y"]


@pytest.mark.parametrize("text, kind, expected", [
    ("12", "int", 12), (" -4 ", "int", -4), ("12.7", "int", 12), ("n/a", "int", None), ("", "int", None),
    (None, "int", None), ("99999999999", "int", None), ("99999999999", "bigint", 99999999999),
    ("true", "boolean", True), (" False", "boolean", False), ("YES", "boolean", True), ("0", "boolean", False),
    ("maybe", "boolean", None), (None, "boolean", None), ("1.5", "double", 1.5), ("one", "double", None),
])
def test_bad_values_become_null(spark, text, kind, expected):
    df = spark.createDataFrame([(1, text)], "id int, x string")
    assert c.with_types(df, {"x": kind}).first()["x"] == expected


@pytest.mark.parametrize("text, expected", [
    ("2024-06-15T08:00:00", datetime(2024, 6, 15, 8)),
    ("2024-06-15T08:00:00Z", datetime(2024, 6, 15, 8)),
    ("2024-06-15T08:00:00.123456+00:00", datetime(2024, 6, 15, 8, 0, 0, 123456)),
    ("2024-06-15T08:00:00+02:00", datetime(2024, 6, 15, 6)),
    ("soon", None), ("", None), (None, None),
])
def test_timestamps_in_every_form(spark, text, expected):
    got = one(spark, text, c.as_timestamp("x").cast("timestamp_ntz"))
    assert got == expected


def test_required_fields(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("b", None)], "id string, n int")
    assert rows(c.require(df, ["id", "n"])) == [("a", 1)]


def test_trim_and_normalise(spark):
    df = spark.createDataFrame([("  A b ", " In "), (None, None)], "x string, y string")
    assert rows(c.with_normalised(c.with_trimmed(df, ["x"]), ["y"])) == [("A b", "in"), (None, None)]


@pytest.mark.parametrize("text, decoded, dropped", [
    ("a<br/>b", "a b", "a b"),
    ("a&lt;br/&gt;b<br/>c", "a b c", "abr/b c"),
    ("it&#39;s &amp; more", "it's & more", "its  more"),
    ("&amp;lt;", "&lt;", "lt;"),
    ("x<br />y<br>z", "x y z", "x<br />y<br>z"),
    (None, None, None),
])
def test_markup(spark, text, decoded, dropped):
    assert one(spark, text, c.clean_markup("x")) == decoded
    assert one(spark, text, c.drop_markup("x")) == dropped


def test_parts(spark):
    df = spark.createDataFrame([("2/3",), ("2",), (None,)], "z string")
    assert rows(df.select(c.part("z", "/", 0), c.part("z", "/", 1))) == [("2", "3"), ("2", None), (None, None)]


@pytest.mark.parametrize("hour, name", [
    (0, "Night"), (4, "Night"), (5, "Early Morning"), (8, "Early Morning"), (9, "Morning"), (11, "Morning"),
    (12, "Lunch"), (13, "Lunch"), (14, "Afternoon"), (16, "Afternoon"), (17, "Evening Rush"), (19, "Evening Rush"),
    (20, "Evening"), (22, "Evening"), (23, "Late Night"), (None, "Night"),
])
def test_hour_bands(spark, hour, name):
    assert one(spark, hour, c.banded(F.col("x"), HOUR_BANDS, OTHER_HOURS), "int") == name


@pytest.mark.parametrize("code, name", [(0, "Severe"), (3, "Major"), (5, "Major"), (6, "Minor"), (9, "Minor"), (10, "Normal"), (11, "Severe")])
def test_severity_bands(spark, code, name):
    assert one(spark, code, c.banded(F.col("x"), SEVERITY_BANDS, OTHER_SEVERITY), "int") == name


def test_audit_time_can_be_fixed(spark):
    df = c.with_audit(spark.range(2), "at", "2024-02-01 00:00:00").select(F.col("at").cast("string"))
    assert rows(df) == [("2024-02-01 00:00:00",)] * 2
    assert c.with_audit(spark.range(1), "at").first()["at"] is not None


def test_time_keys(spark):
    df = spark.createDataFrame([("2024-01-05 23:59:30",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert tuple(df.select(date_key("t"), time_key("t")).first()) == (20240105, 1439)
    filed = c.with_partition_columns(df, "t").drop("t")
    assert tuple(filed.first()) == (2024, 1, 5)
