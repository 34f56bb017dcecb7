import random

import pytest
from pyspark.sql import functions as F

from stresscast.operators.auc import exact_auc


def brute(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_exact_auc_matches_brute_force_with_ties(spark, ranges):
    rnd = random.Random(11)
    data = [(rnd.choice(["a", "b"]), float(rnd.randrange(30)), int(rnd.random() < 0.4)) for _ in range(600)]
    df = spark.createDataFrame(data, "k string, score double, y int")
    got = {r["k"]: r["auc"] for r in exact_auc(df, "score", "y", ["k"]).collect()}
    for k in ("a", "b"):
        assert got[k] == pytest.approx(brute([(s, y) for kk, s, y in data if kk == k]), abs=1e-12)
    g = exact_auc(df, "score", "y").first()["auc"]
    assert g == pytest.approx(brute([(s, y) for _, s, y in data]), abs=1e-12)


def test_auc_negated_score(spark):
    rnd = random.Random(5)
    data = [(float(rnd.randrange(50)), int(rnd.random() < 0.5)) for _ in range(300)]
    df = spark.createDataFrame(data, "score double, y int")
    a = exact_auc(df, "score", "y").first()["auc"]
    b = exact_auc(df.withColumn("score", -F.col("score")), "score", "y").first()["auc"]
    assert a + b == pytest.approx(1.0, abs=1e-12)


def test_auc_single_class_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (None, 0), (3.0, None)], "score double, y int")
    r = exact_auc(df, "score", "y").first()
    assert r["auc"] is None and r["n_pos"] == 2 and r["n_neg"] == 0


def test_auc_equals_spark_ml_exact(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rnd = random.Random(9)
    data = [(float(rnd.randrange(100)) / 7, float(rnd.random() < 0.3)) for _ in range(500)]
    df = spark.createDataFrame(data, "score double, label double")
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert exact_auc(df, "score", "label").first()["auc"] == pytest.approx(ev.evaluate(df), abs=1e-12)
