"""Order statistics over ranges that follow the data: exact for any cut, hot values, hot keys, NULL keys."""

import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stresscast.operators.aggregates import aggregate_region_daily, capacity_daily_median, describe
from stresscast.operators.ranks import RANGE, counted_ranges, exact_quantiles, medians, range_totals


def sample(seed=1):
    rnd = random.Random(seed)
    keys = ["hot"] * 900 + ["a", "b", None] * 40 + ["one"]
    return [(k, rnd.choice([7.5, 7.5, rnd.gauss(0, 10), None])) for k in keys] + [("none", None)]


def test_medians_of_several_columns(spark, ranges):
    rows = [(k, v, None if v is None else -2 * v, i % 3 == 0 and v or None) for i, (k, v) in enumerate(sample())]
    df = spark.createDataFrame(rows, "k string, x double, y double, z double")
    got = {r["k"]: r for r in medians(df, ["x", "y", "z"], ["k"]).collect()}
    assert set(got) == {k for k, *_ in rows}
    for key in got:
        for c, at in (("x", 1), ("y", 2), ("z", 3)):
            values = [r[at] for r in rows if r[0] == key and r[at] is not None]
            assert got[key][f"{c}_n"] == len(values)
            assert got[key][f"{c}_median"] == (pytest.approx(statistics.median(values), abs=1e-12) if values else None)
            assert got[key][f"{c}_mean"] == (pytest.approx(statistics.fmean(values), abs=1e-9) if values else None)


def test_ranges_are_ordered_and_offsets_add_up(spark, ranges):
    df = spark.createDataFrame(sample(2), "k string, x double")
    table = counted_ranges(df, ["k"], "x", {"n": F.count(F.lit(1))})
    rows = table.toPandas()
    assert rows[RANGE].nunique() == (1 if ranges == 1 else rows[RANGE].nunique()) and (ranges == 1 or rows[RANGE].nunique() > 1)
    for _, g in rows.groupby("k", dropna=False):
        spans = g.groupby(RANGE)["x"].agg(["min", "max"])
        assert (spans["min"].to_numpy()[1:] > spans["max"].to_numpy()[:-1]).all()
    if ranges == 40:  # a hot key is many ranges
        assert rows[rows["k"] == "hot"][RANGE].nunique() > 10
    for r in range_totals(table, ["k"], ["n"]).collect():
        same = rows[rows["k"].isna()] if r["k"] is None else rows[rows["k"] == r["k"]]
        assert r["n_before"] == same[same[RANGE] < r[RANGE]]["n"].sum() and r["n_all"] == same["n"].sum()
        assert r["n_here"] == same[same[RANGE] == r[RANGE]]["n"].sum()


def test_quantiles_without_keys_against_numpy(spark, ranges):
    values = [v for _, v in sample(3)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.0, 0.01, 0.5, 0.77, 1.0]
    got = exact_quantiles(df, "x", probs).first()
    want = np.quantile([v for v in values if v is not None], probs)
    assert [got[f"q{i}"] for i in range(len(probs))] == pytest.approx(list(want), abs=1e-9)
    assert exact_quantiles(df.where("false"), "x", probs).first()["q0"] is None


def test_describe_against_pandas(spark, ranges):
    df = spark.createDataFrame(sample(4), "k string, x double")
    for r in describe(df, "x", ["k"]).collect():
        v = pd.Series([x for k, x in sample(4) if k == r["k"]], dtype=float)
        want = v.describe()
        for c, w in zip(("count", "mean", "std", "min", "p25", "p50", "p75", "max"), want):
            assert (r[c] is None and np.isnan(w)) or r[c] == pytest.approx(w, abs=1e-9), (r, want)


def test_region_days_and_capacity_against_python(spark, ranges):
    rnd = random.Random(5)
    rows = [("p" if rnd.random() < 0.9 else None, "r", f"s{rnd.randrange(6)}", f"2024-01-0{rnd.randrange(1, 4)}",
             rnd.choice([None, 1.25, rnd.uniform(-9, 9)]), rnd.choice([None, rnd.uniform(0, 40)])) for _ in range(300)]
    df = spark.createDataFrame(rows, "pipeline string, region_id string, ghcnd_station_id string, date string, tavg_c double, hdd double")
    found = aggregate_region_daily(df).collect()
    want = {}
    for p, _, s, d, t, h in rows:
        if t is not None:
            want.setdefault((p, d), []).append((s, t, h))
    assert {(r["pipeline"], r["date"]) for r in found} == set(want)
    for r in found:
        of = want[r["pipeline"], r["date"]]
        assert r["n_stations_used"] == len({s for s, _, _ in of})
        assert r["tavg_c_median"] == pytest.approx(statistics.median(t for _, t, _ in of))
        assert r["tavg_f_mean"] == pytest.approx(statistics.fmean(t for _, t, _ in of) * 9 / 5 + 32)
        assert r["hdd_median"] == pytest.approx(statistics.median(h for _, _, h in of if h is not None))
    cap = spark.createDataFrame([("p", "2024-01-01", " 5 "), ("p", "2024-01-01", "8"), ("p", "2024-01-01", "x"),
                                 ("p", "bad", "9"), ("p", "2024-01-02", None)], "pipeline string, Post_Date string, All_Qty_Avail string")
    assert sorted((str(r["date"]), r["all_qty_avail_median"]) for r in capacity_daily_median(cap).collect()) == [
        ("2024-01-01", 6.5), ("2024-01-02", None)]


def test_no_group_buffer_is_left(spark):
    df = spark.createDataFrame(sample(6), "k string, x double")
    for plan in (medians(df, ["x"], ["k"]), describe(df, "x", ["k"]), exact_quantiles(df, "x", [0.5], ["k"])):
        text = plan._jdf.queryExecution().toString().lower()
        assert "percentile" not in text and "median(" not in text and "collect_" not in text
