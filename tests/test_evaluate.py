import random

import numpy as np
import pandas as pd
import pytest

from stresscast.operators.aggregates import crosstab_normalized, describe
from stresscast.plans.evaluate import alert_table, baseline_vs_model, qcut, reliability


def data(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows = [(float(rnd.randrange(1000)) / 10, int(rnd.random() < 0.3)) for _ in range(n)]
    return spark.createDataFrame(rows, "score double, y int"), pd.DataFrame(rows, columns=["score", "y"])


def test_qcut_matches_pandas(spark):
    df, pdf = data(spark)
    got = qcut(df, "score", 5).toPandas().sort_values("score", kind="stable")
    exp = pd.qcut(pdf["score"], q=5, labels=False).reindex(pdf.sort_values("score", kind="stable").index)
    assert list(got["bin"]) == list(exp)


def test_qcut_duplicate_edges_raise(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (2.0,)], "score double")
    with pytest.raises(ValueError):
        qcut(df, "score", 5)


def test_reliability(spark):
    df, pdf = data(spark)
    got = reliability(df, "score", "y").toPandas().sort_values("bin")
    exp = pdf.groupby(pd.qcut(pdf["score"], q=5, labels=False))["y"].mean()
    assert np.allclose(got["observed_freq"].to_numpy(), exp.to_numpy())


def test_describe_matches_pandas(spark):
    df, pdf = data(spark)
    got = describe(df, "score").first()
    d = pdf["score"].describe()
    assert got["count"] == d["count"]
    for a, b in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"),
                 ("max", "max")]:
        assert got[a] == pytest.approx(d[b])
    one = describe(df.limit(1), "score").first()
    assert one["std"] is None  # ddof=1 on one row


def test_crosstab_normalized(spark):
    df, pdf = data(spark)
    got = {r["alert"]: (r["frac_0"], r["frac_1"]) for r in alert_table(df, "score", "y", 50.0).collect()}
    exp = pd.crosstab(pdf["score"] > 50.0, pdf["y"], normalize="index")
    for a in (False, True):
        assert got[a][0] == pytest.approx(exp.loc[a, 0]) and got[a][1] == pytest.approx(exp.loc[a, 1])


def test_baseline_vs_model_common_rows(spark):
    rnd = random.Random(2)
    rows = [("p", i, float(rnd.random()), int(rnd.random() < 0.4)) for i in range(200)]
    df = spark.createDataFrame(rows, "pipeline string, date int, score double, y int")
    r = baseline_vs_model(df, "score", "y", ["pipeline"], "date").first()
    assert r["n_pos"] + r["n_neg"] == 200 - 30  # the first 30 rows have no full baseline window
    assert 0.0 <= r["auc_baseline"] <= 1.0 and 0.0 <= r["auc_model"] <= 1.0


def test_exact_quantiles_match_percentile(spark, ranges):
    from pyspark.sql import functions as F
    from stresscast.operators.ranks import exact_quantiles
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", "c"]), float(rnd.randrange(40)) if rnd.random() > 0.05 else None)
            for _ in range(700)] + [("d", 5.0), ("e", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["k"]: [r[f"q{i}"] for i in range(len(probs))]
           for r in exact_quantiles(df, "x", probs, ["k"]).collect()}
    exp = {r["k"]: r["p"] for r in df.groupBy("k").agg(
        F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("p")).collect()}
    for k in ("a", "b", "c", "d"):
        assert got[k] == pytest.approx(exp[k], abs=1e-12), k
    assert "e" not in got  # no values: no row (describe fills NULL)


def test_describe_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "score double")
    r = describe(empty, "score").first()
    assert r["count"] == 0 and r["p25"] is None and r["p50"] is None and r["max"] is None
    nulls = spark.createDataFrame([(None,), (None,)], "score double")
    r = describe(nulls, "score").first()
    assert r["count"] == 0 and r["mean"] is None and r["p75"] is None
    single = spark.createDataFrame([(2.5,)], "score double")
    r = describe(single, "score").first()
    assert (r["count"], r["p25"], r["p50"], r["p75"], r["std"]) == (1, 2.5, 2.5, 2.5, None)
