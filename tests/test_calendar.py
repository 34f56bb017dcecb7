import datetime as dt

from stresscast.operators.calendar import weekly_to_daily_ffill
from tests.conftest import rows

D = dt.date


def test_ffill_null_inside_and_range(spark):
    w = spark.createDataFrame([("r", D(2024, 1, 1), 10.0), ("r", D(2024, 1, 8), None), ("r", D(2024, 1, 15), 30.0),
                               ("s", D(2024, 1, 1), 5.0)], "region string, date date, v double")
    out = rows(weekly_to_daily_ffill(w, ["v"], ["region"]), "region", "date")
    r = [x for x in out if x["region"] == "r"]
    assert len(r) == 15  # first to last weekly date, no fill beyond
    assert r[0]["v"] == 10.0 and r[7]["v"] == 10.0 and r[13]["v"] == 10.0 and r[14]["v"] == 30.0
    s = [x for x in out if x["region"] == "s"]
    assert s == [{"region": "s", "date": D(2024, 1, 1), "v": 5.0}]  # single week: one day


def test_leading_null_stays_null_and_duplicates_keep_last(spark):
    w = spark.createDataFrame([(D(2024, 1, 1), None, 0), (D(2024, 1, 8), 2.0, 0), (D(2024, 1, 8), 3.0, 1)],
                              "date date, v double, seq int")
    out = rows(weekly_to_daily_ffill(w, ["v"], [], tie_breakers=["seq"]), "date")
    assert out[0]["v"] is None and out[6]["v"] is None
    assert out[7]["v"] == 3.0 and len(out) == 8


def test_empty(spark):
    w = spark.createDataFrame([], "date date, v double")
    assert weekly_to_daily_ffill(w, ["v"]).count() == 0
