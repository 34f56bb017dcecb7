import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stresscast.operators.windows import lag, log_return, rolling, rolling_long
from tests.conftest import rows


def frame(spark, shuffle=False):
    rnd = random.Random(3)
    data = []
    for p in ("a", "b"):
        for i in range(12):
            v = None if (p == "a" and i in (4, 9)) else float(rnd.randrange(1, 50))
            data.append((p, dt.date(2024, 1, 1) + dt.timedelta(days=i), v))
    if shuffle:
        rnd.shuffle(data)
    return spark.createDataFrame(data, "pipeline string, date date, x double").repartition(3)


def pandas_rolling(pdf, n, fn, minp, shift=0):
    out = {}
    for p, g in pdf.sort_values("date").groupby("pipeline"):
        r = getattr(g["x"].rolling(n, min_periods=minp), fn)().shift(shift)
        out.update({(p, d): (None if pd.isna(v) else v) for d, v in zip(g["date"], r)})
    return out


@pytest.mark.parametrize("n,fn,minp,shift", [(3, "mean", None, 0), (5, "mean", 1, 0), (7, "sum", 1, 0),
                                             (4, "mean", None, 1), (20, "mean", None, 0)])
def test_rolling_matches_pandas(spark, n, fn, minp, shift):
    df = frame(spark)
    pdf = df.toPandas()
    exp = pandas_rolling(pdf, n, fn, minp if minp is not None else n, shift)
    got = {(r["pipeline"], r["date"]): r["v"] for r in
           df.select("pipeline", "date", rolling("x", n, fn, min_periods=minp, shift=shift).alias("v")).collect()}
    for k, v in exp.items():
        assert (got[k] is None and v is None) or got[k] == pytest.approx(v), k


def test_shuffled_input_same_result(spark):
    a = rows(frame(spark).select("pipeline", "date", rolling("x", 3).alias("v"), lag("x").alias("l")), "pipeline", "date")
    b = rows(frame(spark, True).select("pipeline", "date", rolling("x", 3).alias("v"), lag("x").alias("l")),
             "pipeline", "date")
    assert a == b


def test_log_return_gaps_zero_negative(spark):
    data = [("p", dt.date(2024, 1, d), v) for d, v in [(1, 2.0), (2, None), (3, 4.0), (4, 0.0), (5, -1.0), (6, 8.0),
                                                       (7, 16.0)]]
    df = spark.createDataFrame(data, "pipeline string, date date, x double")
    got = [r["r"] for r in rows(df.select("date", log_return("x").alias("r")), "date")]
    assert got[0] is None and got[1] is None and got[2] is None  # a gap nulls the gap row and the next one
    assert got[3] is None and got[4] is None and got[5] is None   # ln(0), ln(<0) are NULL
    assert got[6] == pytest.approx(math.log(2.0))


@pytest.mark.parametrize("n,fn,minp,shift", [(3, "mean", None, 0), (5, "mean", 1, 0), (7, "sum", 1, 0),
                                             (4, "mean", None, 1), (5, "sum", 2, 3), (20, "mean", None, 0), (1, "sum", 1, 0)])
def test_long_window_equals_the_sliding_frame(spark, n, fn, minp, shift):
    df = frame(spark)
    both = df.select("pipeline", "date", rolling("x", n, fn, min_periods=minp, shift=shift).alias("a"),
                     rolling_long("x", n, fn, min_periods=minp, shift=shift).alias("b")).collect()
    assert all(r["a"] == r["b"] if r["a"] is None else r["b"] == pytest.approx(r["a"], abs=1e-12) for r in both)


def test_long_window_over_many_rows_is_exact(spark):
    """1095 rows: equal to the sliding frame, exactly so where it has no rounding, and huge values leave nothing behind."""
    rnd = random.Random(8)
    start = dt.date(2000, 1, 1)
    data = [("p", start + dt.timedelta(days=i), rnd.choice([None, float("nan")]) if i in (5, 1800) else
             2.0**40 if i == 100 else rnd.randrange(10**7) / 64) for i in range(4000)]
    df = spark.createDataFrame(data, "pipeline string, date date, x double")
    clean = df.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    a = rows(clean.select("date", rolling("x", 1095, "sum").alias("v"), rolling("x", 1095).alias("m")), "date")
    b = rows(df.select("date", rolling_long("x", 1095, "sum").alias("v"), rolling_long("x", 1095).alias("m")), "date")
    assert [r["v"] for r in a] == [r["v"] for r in b]  # binary fractions: the frame's own sums are exact
    assert [r["m"] for r in a] == [r["m"] for r in b] and sum(r["v"] is not None for r in b) > 600


def test_long_window_has_growing_frames_only(spark):
    plan = frame(spark).select(rolling_long("x", 1095).alias("v"))._jdf.queryExecution().toString()
    assert "-1094" not in plan and "unboundedpreceding" in plan
