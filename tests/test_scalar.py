import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stresscast.functions import scalar as S


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_c_to_f_and_hdd(spark):
    df = spark.createDataFrame([(0.0,), (20.0,), (None,), (-10.0,)], "t double")
    got = [r["h"] for r in df.select(S.hdd_from_tavg_c("t").alias("h")).collect()]
    assert got[0] == pytest.approx(65 - 32)
    assert got[1] == 0.0  # warmer than the base: clamped at 0
    assert got[2] is None  # null in, null out (greatest would skip the null)
    assert got[3] == pytest.approx(65 - 14)


@pytest.mark.parametrize("raw,expected", [("12.5", 12.5), (" 7 ", 7.0), ("abc", None), ("", None), ("NaN", None),
                                          (None, None)])
def test_to_double_lenient(spark, raw, expected):
    assert one(spark, S.to_double("x"), raw) == expected


@pytest.mark.parametrize("raw,expected", [
    ("12/01/2025 08:05:00 AM", dt.datetime(2025, 12, 1, 8, 5)),
    ("1/2/2025 1:05:09 pm", dt.datetime(2025, 1, 2, 13, 5, 9)),
    ("  3/04/2025 12:00:00 PM\n", dt.datetime(2025, 3, 4, 12, 0)),
    ("", None), ("   ", None), ("2025-01-01", None), (None, None)])
def test_parse_notice_ts(spark, raw, expected):
    got = one(spark, S.parse_notice_ts("x"), raw)
    assert (got.replace(tzinfo=None) if got else got) == expected


def test_strip_and_normalize_space(spark):
    assert one(spark, S.strip_ws("x"), "\t a b \n") == "a b"
    assert one(spark, S.normalize_space("x"), "  a \n\t b  ") == "a b"


def test_clean_text_list_and_safe_get(spark):
    df = spark.createDataFrame([(["  a ", " ", None, "\nb", ""],)], "arr array<string>")
    r = df.select(S.clean_text_list("arr").alias("c")).first()["c"]
    assert r == ["a", "b"]
    d2 = df.select(S.clean_text_list("arr").alias("c"))
    got = d2.select(S.safe_get("c", 1).alias("x"), S.safe_get("c", 5).alias("y"),
                    S.safe_get("c", -1).alias("z")).first()
    assert (got["x"], got["y"], got["z"]) == ("b", "", "")


def test_date_range_guard(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3), dt.date(2024, 1, 1)), (dt.date(2024, 1, 1), dt.date(2024, 1, 2))],
                               "s date, e date")
    got = [r["d"] for r in df.select(S.date_range("s", "e").alias("d")).collect()]
    assert got[0] == []  # end before start: empty, not backwards
    assert got[1] == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_safe_ln(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (math.e,), (None,)], "x double")
    got = [r["l"] for r in df.select(S.safe_ln("x").alias("l")).collect()]
    assert got[0] is None and got[1] is None and got[3] is None
    assert got[2] == pytest.approx(1.0)


@pytest.mark.parametrize("label,expected,legacy", [("CRITICAL", True, False), ("Non-Critical", False, False),
                                                   ("Non-Critical", True, True), ("info", False, False)])
def test_critical_flag(spark, label, expected, legacy):
    assert one(spark, S.critical_flag("x", legacy), label) is expected


def test_sigmoid_and_clamp(spark):
    df = spark.createDataFrame([(0.0, 1.5), (None, None)], "x double, nu double")
    r = df.select(S.sigmoid("x").alias("s"), S.clamp_low("nu", 2.1).alias("n")).collect()
    assert r[0]["s"] == 0.5 and r[0]["n"] == 2.1
    assert r[1]["s"] is None and r[1]["n"] is None
