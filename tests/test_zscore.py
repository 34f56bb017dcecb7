import pytest
from pyspark.sql import functions as F

from stresscast.operators.zscore import standardize


def df(spark, vals):
    return spark.createDataFrame([("k", v) for v in vals], "k string, x double")


def z(spark, vals, policy, **kw):
    out, st = standardize(df(spark, vals), ["x"], ["k"], policy, **kw)
    return [r["x_z"] for r in out.collect()], st.first()


def test_policy_a(spark):
    got, st = z(spark, [1.0, 2.0, 3.0, None], "a")
    sd = (2 / 3) ** 0.5
    assert got[0] == pytest.approx(-1 / sd) and got[3] is None
    got, _ = z(spark, [5.0, 5.0], "a")           # constant: divide by 1
    assert got == [0.0, 0.0]
    got, _ = z(spark, [1.0, 1.0 + 1e-12], "a")   # tiny std below eps: divide by 1
    assert got[1] == pytest.approx(5e-13, abs=1e-15)  # (x - mean) / 1
    got, _ = z(spark, [None, None], "a")          # all null: NULL
    assert got == [None, None]


def test_policy_b_constant_gives_zeros_even_for_null(spark):
    got, _ = z(spark, [5.0, None, 5.0], "b")
    assert got == [0.0, 0.0, 0.0]
    got, _ = z(spark, [None, None], "b")
    assert got == [0.0, 0.0]


def test_given_stats(spark):
    st = spark.createDataFrame([("k", 10.0, 2.0)], "k string, x__mean double, x__std double")
    got, _ = z(spark, [12.0, None], "c", stats=st)
    assert got == [1.0, None]
    st0 = spark.createDataFrame([("k", 10.0, 0.0)], "k string, x__mean double, x__std double")
    got, _ = z(spark, [12.0], "c", stats=st0)
    assert got == [0.0]


def test_global_stats_no_keys(spark):
    out, st = standardize(df(spark, [1.0, 3.0]), ["x"], [], "a")
    assert sorted(r["x_z"] for r in out.collect()) == [-1.0, 1.0]
