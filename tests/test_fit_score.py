import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stresscast.plans.fit import draws_from_posterior, fit_logistic, fit_student_t
from stresscast.plans.score import exceed_probs, score_points


def logistic_data(spark, n=800, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for k, (a, b1, b2) in {"p": (-0.5, 1.0, -0.7), "q": (0.3, -0.4, 0.2)}.items():
        x1, x2 = rng.normal(size=n), rng.normal(size=n)
        y = (rng.random(n) < 1 / (1 + np.exp(-(a + b1 * x1 + b2 * x2)))).astype(int)
        rows += [(k, float(u), float(v), int(w)) for u, v, w in zip(x1, x2, y)]
    return spark.createDataFrame(rows, "k string, x1 double, x2 double, y int"), pd.DataFrame(rows, columns=["k", "x1", "x2", "y"])


def test_logistic_newton_gradient_zero(spark):
    df, pdf = logistic_data(spark)
    params, post = fit_logistic(df, ["x1", "x2"], "y", ["k"])
    est = {(r["k"], r["param"]): r["estimate"] for r in params.collect()}
    for k, g in pdf.groupby("k"):
        X = np.column_stack([np.ones(len(g)), g["x1"], g["x2"]])
        th = np.array([est[(k, "a")], est[(k, "b_x1")], est[(k, "b_x2")]])
        mu = 1 / (1 + np.exp(-X @ th))
        grad = X.T @ (g["y"] - mu) - np.array([1 / 1.5 ** 2, 1, 1]) * th
        assert np.max(np.abs(grad)) < 1e-6
    assert {r["param"] for r in params.collect()} == {"a", "b_x1", "b_x2"}


def test_draws_shape_and_mean(spark):
    df, _ = logistic_data(spark, 400, 1)
    params, post = fit_logistic(df, ["x1", "x2"], "y", ["k"])
    dr = draws_from_posterior(post, ["k"], n_chains=2, n_draws=3000, seed=3).toPandas()
    assert len(dr) == 2 * 2 * 3000 and set(dr.columns) == {"k", "chain", "draw", "a", "b_x1", "b_x2"}
    est = {(r["k"], r["param"]): (r["estimate"], r["std_error"]) for r in params.collect()}
    for k, g in dr.groupby("k"):
        m, se = est[(k, "b_x1")]
        assert abs(g["b_x1"].mean() - m) < 4 * se / np.sqrt(len(g)) + 1e-9
    dr2 = draws_from_posterior(post, ["k"], n_chains=2, n_draws=3000, seed=3).toPandas()
    pd.testing.assert_frame_equal(dr.sort_values(["k", "chain", "draw"]).reset_index(drop=True),
                                  dr2.sort_values(["k", "chain", "draw"]).reset_index(drop=True))


def test_student_t_fit_recovers(spark):
    rng = np.random.default_rng(4)
    n = 1500
    x = rng.normal(size=n)
    y = 0.2 + 0.5 * x + 0.3 * rng.standard_t(4, size=n)
    df = spark.createDataFrame([("p", float(a), float(b)) for a, b in zip(x, y)], "k string, x double, y double")
    params, post = fit_student_t(df, ["x"], "y", ["k"])
    est = {r["param"]: r["estimate"] for r in params.collect()}
    assert est["a"] == pytest.approx(0.2, abs=0.05) and est["b_x"] == pytest.approx(0.5, abs=0.05)
    assert est["sigma"] == pytest.approx(0.3, abs=0.06) and 2.5 <= est["nu"] <= 10
    dr = draws_from_posterior(post, ["k"], n_chains=2, n_draws=200, seed=1).toPandas()
    assert (dr["nu"] > 2).all() and (dr["sigma"] > 0).all()


def test_student_t_std_errors_match_numeric_hessian(spark):
    """Covariance at the mode against finite differences of the log posterior in (a, b, log sigma)."""
    import math
    rng = np.random.default_rng(7)
    n, nu = 2000, 3.0
    x = rng.normal(size=n)
    y = 0.1 + 0.4 * x + 0.25 * rng.standard_t(nu, size=n)
    df = spark.createDataFrame([("p", float(a), float(b)) for a, b in zip(x, y)], "k string, x double, y double").repartition(3)
    params, post = fit_student_t(df, ["x"], "y", ["k"], nu_grid=(nu,  nu + 1e-9))
    est = {r["param"]: (r["estimate"], r["std_error"]) for r in params.collect()}

    def objective(t):
        a, b, ls = t
        r = y - a - b * x
        return float(-(nu + 1) / 2 * np.log1p(r * r / (nu * math.exp(2 * ls))).sum() - n * ls
                     - (a * a + b * b) / 0.5 - math.exp(2 * ls) / 0.5 + ls)
    mode = np.array([est["a"][0], est["b_x"][0], est["log_sigma"][0]])
    h, eye = 1e-4, np.eye(3)
    grad = [(objective(mode + h * e) - objective(mode - h * e)) / (2 * h) for e in eye]
    assert np.max(np.abs(grad)) < 0.05
    hess = np.array([[(objective(mode + h * (d + e)) - objective(mode + h * (d - e)) - objective(mode - h * (d - e))
                       + objective(mode - h * (d + e))) / (4 * h * h) for e in eye] for d in eye])
    want = np.sqrt(np.diag(np.linalg.inv(-hess)))
    assert [est["a"][1], est["b_x"][1], est["log_sigma"][1]] == pytest.approx(want.tolist(), rel=1e-3)


def test_fit_without_convergence_raises(spark):
    from stresscast.plans.fit import NotConverged
    df, _ = logistic_data(spark, 100, 2)
    with pytest.raises(NotConverged):
        fit_logistic(df, ["x1", "x2"], "y", ["k"], max_iter=1)


def test_stress_backtest_scores_every_test_row(spark):
    from pyspark.sql import functions as F
    from stresscast.plans.backtest import stress_backtest
    from stresscast.plans.catalogue import TRAIN_END, model_frame
    frame = model_frame(spark, "/root/testdata/sf0.001")
    for mode in ("history", "test_rows"):
        _, scored = stress_backtest(frame, TRAIN_END, n_chains=1, n_draws=50, inputs=mode)
        got = scored.agg(F.count("*").alias("n"), F.countDistinct("pipeline", "date").alias("d"),
                         F.count("stress_event").alias("y")).first()
        assert got["n"] == got["d"] == got["y"] == frame.where(F.col("date") > TRAIN_END).count()


def test_exceed_probs_brute_force():
    rng = np.random.default_rng(0)
    draws = pd.DataFrame({"a": rng.normal(size=300), "b_x": rng.normal(size=300)})
    X = rng.normal(size=(50, 1))
    got = exceed_probs(X, draws, ["x"], "stress", 0.3)
    for i in range(50):
        p = [1 / (1 + np.exp(-(a + b * X[i, 0]))) for a, b in zip(draws["a"], draws["b_x"])]
        assert got[i] == pytest.approx(np.mean(np.array(p) > 0.3))


def test_score_points_skip_unknown_and_nulls(spark):
    draws = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "a double, b_x double")
    pts = spark.createDataFrame([("p", 1, 2.0, 5.0), ("p", 2, None, 1.0)], "k string, date int, x double, z double")
    out = {r["date"]: r["prob"] for r in score_points(pts, draws, ["x", "z"], keys=["k"], null_as_zero=True).collect()}
    assert out[1] == 1.0 and out[2] == 0.0  # z has no coefficient (skipped); NULL x scores 0 like NaN > t
    out2 = {r["date"]: r["prob"] for r in score_points(pts, draws, ["x"], keys=["k"]).collect()}
    assert out2[2] is None
    with pytest.raises(KeyError):
        score_points(pts, draws, ["x", "z"], keys=["k"], strict=True)


def test_vol_scoring_seeded_reproducible(spark):
    draws = spark.createDataFrame([("p", 0.0, 0.5, 0.1, 1.5), ("p", 0.01, 0.4, 0.2, 8.0)] * 50,
                                  "k string, a double, b_x double, sigma double, nu double")
    pts = spark.createDataFrame([("p", i, float(i) / 10) for i in range(20)], "k string, date int, x double")
    a = score_points(pts, draws, ["x"], "vol", 0.02, keys=["k"], seed=7).toPandas().sort_values("date")
    b = score_points(pts, draws, ["x"], "vol", 0.02, keys=["k"], seed=7).toPandas().sort_values("date")
    assert list(a["prob"]) == list(b["prob"])


def test_vol_backtest_both_input_modes(spark):
    from pyspark.sql import functions as F
    from stresscast.plans.backtest import vol_backtest
    from stresscast.plans.catalogue import TRAIN_END, model_frame
    frame = model_frame(spark, "/root/testdata/sf0.001")
    for mode in ("design", "forecast"):
        _, scored = vol_backtest(frame, TRAIN_END, n_chains=2, n_draws=100, inputs=mode)
        test_rows = frame.where(F.col("date") > TRAIN_END).count()
        assert scored.count() == test_rows and scored.select("pipeline", "date").distinct().count() == test_rows
        if mode == "forecast":
            assert scored.where("p_vol_exceed is not null").count() == 0  # fewer than 1095 test rows a pipeline
            continue
        r = scored.agg(F.count("*").alias("n"), F.min("p_vol_exceed").alias("lo"), F.max("p_vol_exceed").alias("hi"),
                       F.min("date").alias("first")).first()
        assert r["n"] > 0 and 0.0 <= r["lo"] <= r["hi"] <= 1.0, mode
        assert str(r["first"]) > TRAIN_END


def test_null_and_empty_keys_are_models_of_their_own(spark):
    rng = np.random.default_rng(11)
    rows = [(k, float(x), int(rng.random() < 1 / (1 + np.exp(-s * x)))) for k, s in ((None, 2.0), ("", -2.0), ("p", 0.5))
            for x in rng.normal(size=300)]
    df = spark.createDataFrame(rows, "k string, x double, y int")
    params, post = fit_logistic(df, ["x"], "y", ["k"])
    est = {r["k"]: r["estimate"] for r in params.where("param = 'b_x'").collect()}
    assert est[None] > 1 and est[""] < -1 and len(est) == 3
    alone = {r["param"]: r["estimate"] for r in fit_logistic(df.where("k = ''"), ["x"])[0].collect()}
    assert alone["b_x"] == pytest.approx(est[""], abs=1e-9)
    draws = draws_from_posterior(post, ["k"], n_chains=1, n_draws=50)
    scored = score_points(df.select("k", F.monotonically_increasing_id().alias("date"), "x"), draws, ["x"], keys=["k"])
    assert scored.where("prob is not null").count() == 900


def test_many_keys_and_a_hot_one(spark):
    """3,000 models in one fit, one of them with a third of all rows; equal to fits of their own."""
    rng = np.random.default_rng(12)
    k = np.concatenate([np.repeat(np.arange(3000), 4), np.zeros(6000, int)])
    x = rng.normal(size=len(k))
    y = (rng.random(len(k)) < 1 / (1 + np.exp(-x))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"k": k, "x": x, "y": y})).repartition(5)
    params, _ = fit_logistic(df, ["x"], "y", ["k"])
    est = {(r["k"], r["param"]): r["estimate"] for r in params.collect()}
    assert len(est) == 6000
    for key in (0, 17, 2999):
        one = {r["param"]: r["estimate"] for r in fit_logistic(df.where(F.col("k") == key), ["x"])[0].collect()}
        assert [one["a"], one["b_x"]] == pytest.approx([est[key, "a"], est[key, "b_x"]], abs=1e-8)


def test_blocks_hold_every_row_once(spark):
    from stresscast.plans.blocks import key_blocks, matrix
    rows = [(k, i, float(i) if i % 7 else None) for i, k in enumerate(["a"] * 5000 + ["b", None] * 50)]
    df = spark.createDataFrame(rows, "k string, i int, x double").repartition(3)
    found = key_blocks(df, ["k"], ["x"], ["i", "k"]).collect()
    assert max(len(r["_i"]) for r in found) <= 2048
    got = {i: (r["k"], v) for r in found for i, v in zip(r["_i"], matrix(bytes(r["block"]), 1)[:, 0])}
    assert len(got) == sum(len(r["_i"]) for r in found) == len(rows)
    assert all(got[i][0] == k and (np.isnan(got[i][1]) if x is None else got[i][1] == x) for k, i, x in rows)
    assert all(set(r["_k"]) == {r["k"]} for r in found)


def test_student_t_variates_have_the_right_distribution():
    from stresscast.plans.score import hashed_uniforms, student_t
    seeds = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 400)
    u = hashed_uniforms(seeds, 500, 0)
    assert abs(u.mean() - 0.5) < 0.003 and abs(u.var() - 1 / 12) < 0.001 and 0 < u.min() and u.max() < 1
    assert abs(np.corrcoef(u[:, :-1].ravel(), u[:, 1:].ravel())[0, 1]) < 0.01
    assert abs(np.corrcoef(u[:-1].ravel(), u[1:].ravel())[0, 1]) < 0.01
    for nu in (2.1, 4.0, 30.0):
        t = student_t(seeds, np.full(500, nu)).ravel()
        want = np.random.default_rng(2).standard_t(nu, 2_000_000)
        qs = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
        assert np.allclose(np.quantile(t, qs), np.quantile(want, qs), atol=0.03 * (1 + np.abs(np.quantile(want, qs))))


def test_vol_scores_against_the_normal_limit(spark):
    """Points of one model: the share of draws above the threshold, with fixed variates exactly so."""
    t = [(-1.5 + i / 100) for i in range(301)]
    draws = spark.createDataFrame([("p", i, 0.1, 0.5, 0.2, v) for i, v in enumerate(t)],
                                  "k string, draw int, a double, b_x double, sigma double, t double")
    pts = spark.createDataFrame([("p", i, i / 10) for i in range(30)] + [("q", 1, 0.0), ("p", 99, None)],
                                "k string, date int, x double")
    got = {(r["k"], r["date"]): r["prob"] for r in
           score_points(pts, draws, ["x"], "vol", 0.75, keys=["k"], variate="t").collect()}
    for i in range(30):
        assert got["p", i] == np.mean([0.1 + 0.5 * (i / 10) + 0.2 * v > 0.75 for v in t])
    assert got["q", 1] is None and got["p", 99] is None and len(got) == 32


def counted(spark, frame):
    """A frame that counts its rows as they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    return frame.mapInArrow(count, frame.schema), seen


@pytest.mark.parametrize("mode", ["design", "forecast"])
def test_vol_backtest_computes_the_frame_once(spark, mode):
    from stresscast.plans.backtest import vol_backtest
    from stresscast.plans.catalogue import TRAIN_END, model_frame
    from stresscast.session import staged
    rows = staged(model_frame(spark, "/root/testdata/sf0.001"), "frame")
    frame, seen = counted(spark, rows)
    vol_backtest(frame, TRAIN_END, n_chains=1, n_draws=10, inputs=mode)[1].collect()
    assert seen.value == rows.count()


@pytest.mark.parametrize("query", ["fit_stress_gradient", "fit_vol_gradient"])
def test_gradients_compute_the_frame_once(spark, query, monkeypatch):
    from stresscast.plans import catalogue
    from stresscast.session import staged
    rows = staged(catalogue.model_frame(spark, "/root/testdata/sf0.001"), "frame")
    frame, seen = counted(spark, rows)
    monkeypatch.setattr(catalogue, "model_frame", lambda *_: frame)
    catalogue.QUERIES[query](spark, "/root/testdata/sf0.001").collect()
    assert seen.value == rows.count()
