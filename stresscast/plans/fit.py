"""Model fits as iterative Spark plans (M3, M5) and posterior draws.

The source draws posteriors with a single-machine NUTS sampler. Here the same
likelihoods and priors are fitted to their posterior mode, for all model keys
at once, and the state of a fit is a table with one row per key:

1. the design is packed once into blocks of rows of one key (``plans/blocks.py``);
2. a pass joins the blocks to the state table by key (Spark broadcasts the state while it is small and sorts
   both sides beyond that, splitting skewed keys), sums a vector of statistics per key, and solves each key's small
   system in the task that holds its sums. The new state is written in the shared folder, so lineage does not
   grow and a lost executor repeats one pass at most;
3. the largest step is observed while the state is written; that one number is all that reaches the driver.

* M3 stress: y ~ Bernoulli(sigmoid(a + b.x)), a ~ N(0, 1.5), b ~ N(0, 1); Newton.
* M5 volatility: y ~ StudentT(nu, a + b.x, sigma), a, b ~ N(0, 0.5),
  sigma ~ HalfNormal(0.5), nu = 2 + Exponential(rate 1/10). For every nu of a
  fixed grid, damped Newton steps in (a, b, log sigma) advance together in the
  same pass; the grid's profile log posterior gives the draw weights of nu.
  Draws carry the true nu (the +2 included, §8 Q4).

Posterior draws come from the Laplace (normal) approximation at the mode and are
generated by Spark tasks, seeded per (key, chain). Rows with a NULL target or
feature are left out; a NULL key is a key of its own.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from stresscast.operators.ranks import join_null_safe
from stresscast.plans.blocks import key_blocks, matrix
from stresscast.session import staged

# Support of nu = 2 + Exponential(0.1): the grid ends where the prior has e^-12 left beyond it.
NU_GRID = (2.05, 2.5, 3.0, 4.0, 5.0, 7.0, 10.0, 15.0, 20.0, 30.0, 50.0, 80.0, 122.0)


class NotConverged(RuntimeError):
    """A fit used up its passes; carries the number of passes and the last step."""

    def __init__(self, passes: int, step: float) -> None:
        super().__init__(f"no convergence after {passes} passes (last step {step:.3g})")
        self.passes, self.step = passes, step


def _blocks(design: DataFrame, keys: Sequence[str], feats: Sequence[str], y: str) -> DataFrame:
    """Target and features in blocks of one key; rows with a NULL are left out."""
    d = design.select(*keys, F.col(y).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f) for f in feats])
    return staged(key_blocks(d.dropna(subset=["_y", *feats]), keys, ["_y", *feats]), "design")


def iterate(blocks: DataFrame, keys: Sequence[str], start: DataFrame, width: int, n_stats: int, stats: Callable,
            update: Callable, max_iter: int, tol: float) -> DataFrame:
    """Passes over the blocks until no key's step exceeds ``tol``; returns the state table ``keys, state``.

    ``start``: ``keys, state`` (array of doubles). ``stats(state, X, y)``: additive statistics of a block, with ``X`` led by a
    column of ones. ``update(state, sums)``: the next state and the size of the step. ``width``: columns of a block.
    """
    keys = list(keys)
    kf = [blocks.schema[k] for k in keys]
    sums_schema = StructType(kf + [StructField("i", IntegerType()), StructField("v", DoubleType())])
    state_schema = StructType(kf + [StructField("state", ArrayType(DoubleType())), StructField("step", DoubleType())])

    def block_sums(batches):
        for batch in batches:
            out = [stats(np.asarray(batch.column("state")[i].values, float), *_design(batch.column("block")[i], width))
                   for i in range(batch.num_rows)]
            row = pa.array(np.repeat(np.arange(batch.num_rows), n_stats))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(row) for k in keys),
                 pa.array(np.tile(np.arange(n_stats, dtype=np.int32), batch.num_rows)),
                 pa.array(np.concatenate(out) if out else np.zeros(0))], names=sums_schema.names)

    def solve(batches):
        for batch in batches:
            states, steps = [], []
            for i in range(batch.num_rows):
                index, value = (np.asarray(batch.column("_s")[i].values.field(f)) for f in ("i", "v"))
                sums = np.zeros(n_stats)
                sums[index[index >= 0]] = value[index >= 0]
                held = index < 0  # the former state, last entry first
                state, step = update(value[held][::-1], sums)
                states.append(state)
                steps.append(step)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(states, pa.list_(pa.float64())), pa.array(steps, pa.float64())],
                names=state_schema.names)

    state, step = staged(start, "fit"), math.inf
    for _ in range(max_iter):
        sums = join_null_safe(blocks, state.select(*keys, "state"), keys).mapInArrow(block_sums, sums_schema)
        former = state.select(*keys, F.posexplode("state").alias("i", "v")).withColumn("i", -1 - F.col("i"))
        total = sums.unionByName(former).groupBy(*keys, "i").agg(F.sum("v").alias("v"))
        by_key = total.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("_s")).where("size(_s) > 0")
        seen = Observation()
        state = staged(by_key.mapInArrow(solve, state_schema).observe(seen, F.max("step").alias("step")), "fit")
        step = seen.get["step"]
        if step is None or step <= tol:  # no keys at all: nothing to fit
            return state.select(*keys, "state")
    raise NotConverged(max_iter, step)


def _design(block, width: int) -> tuple[np.ndarray, np.ndarray]:
    m = matrix(block.as_py(), width)
    return np.column_stack([np.ones(len(m)), m[:, 1:]]), m[:, 0]


def _triangle(values: np.ndarray, p: int) -> np.ndarray:
    """Symmetric matrix from its upper triangle."""
    h = np.zeros((p, p))
    h[np.triu_indices(p)] = values
    return h + np.triu(h, 1).T


def _params(posterior: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per key and parameter: estimate and Laplace standard error."""
    p = len(names)
    rows = F.array(*[F.struct(F.lit(n).alias("param"), F.col("mode")[i].alias("estimate"),
                              F.sqrt(F.greatest(F.col("cov")[i * (p + 1)], F.lit(0.0))).alias("std_error"))
                     for i, n in enumerate(names)])
    return posterior.select(*keys, F.inline(rows))


def fit_logistic(design: DataFrame, features: Sequence[str], y: str = "y", keys: Sequence[str] = (),
                 prior_sd_a: float = 1.5, prior_sd_b: float = 1.0, max_iter: int = 50, tol: float = 1e-8):
    """M3: MAP logistic regression per key by Newton steps. Returns ``(params, posterior)``.

    ``params``: keys, param, estimate, std_error (Laplace). ``posterior``:
    per key the mode and the covariance (for :func:`draws_from_posterior`).
    """
    keys, feats = list(keys), list(features)
    names = ["a"] + [f"b_{f}" for f in feats]
    p = len(names)
    prec = np.diag([1.0 / prior_sd_a ** 2] + [1.0 / prior_sd_b ** 2] * len(feats))
    upper = np.triu_indices(p)

    def stats(state, X, y):
        mu = 1.0 / (1.0 + np.exp(-(X @ state[:p])))
        return np.concatenate([X.T @ (y - mu), (X.T @ (X * (mu * (1.0 - mu))[:, None]))[upper]])

    def update(state, sums):
        H = _triangle(sums[p:], p) + prec
        delta = np.linalg.solve(H, sums[:p] - prec @ state[:p])
        return np.concatenate([state[:p] + delta, H.ravel()]), float(np.abs(delta).max())

    blocks = _blocks(design, keys, feats, y)
    start = blocks.select(*keys).distinct() if keys else blocks.agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    start = start.select(*keys, F.array_repeat(F.lit(0.0), p + p * p).alias("state"))
    state = iterate(blocks, keys, start, p, p + len(upper[0]), stats, update, max_iter, tol)
    schema = StructType([state.schema[k] for k in keys] + [StructField("mode", ArrayType(DoubleType())),
                                                           StructField("cov", ArrayType(DoubleType()))])

    def finish(batches):
        for batch in batches:
            found = [np.asarray(s.values, float) for s in batch.column("state")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array([s[:p] for s in found], pa.list_(pa.float64())),
                 pa.array([np.linalg.inv(s[p:].reshape(p, p)).ravel() for s in found], pa.list_(pa.float64()))],
                names=schema.names)

    posterior = state.mapInArrow(finish, schema).withColumn("names", F.array(*[F.lit(n) for n in names]))
    return _params(posterior, keys, names), posterior


def draws_from_posterior(posterior: DataFrame, keys: Sequence[str] = (), n_chains: int = 4, n_draws: int = 1500,
                         seed: int = 0) -> DataFrame:
    """Laplace draws: one row per (keys, chain, draw) with one column per parameter.

    Generated inside tasks (``mapInPandas``), seeded per (seed, key, chain),
    so the draw table never passes through the driver. For the volatility
    posterior, nu is drawn from its grid weights first, then (a, b, log sigma)
    from the normal approximation at that nu's mode.
    """
    keys = list(keys)
    first = posterior.select("names").first()
    names = list(first["names"]) if first else []
    is_vol = "nu_grid" in posterior.columns
    out_names = names[:-1] + ["sigma", "nu"] if is_vol else names
    kf = [posterior.schema[k] for k in keys]
    schema = StructType(kf + [StructField("chain", IntegerType()), StructField("draw", IntegerType())] +
                        [StructField(n, DoubleType()) for n in out_names])
    cols = keys + ["mode", "cov", "names"] + (["nu_grid", "nu_weight", "nu_modes", "nu_covs"] if is_vol else [])

    def gen(it):
        for pdf in it:
            parts = []
            for _, r in pdf.iterrows():
                kh = zlib.crc32("\x1f".join(str(r[k]) for k in keys).encode())
                p = len(r["mode"])
                for c in range(n_chains):
                    rng = np.random.default_rng([seed & 0xFFFFFFFF, kh, c])
                    if is_vol:
                        w = np.asarray(r["nu_weight"], float)
                        idx = rng.choice(len(w), size=n_draws, p=w / w.sum())
                        vals = np.empty((n_draws, p))
                        for gi in np.unique(idx):
                            m = np.asarray(r["nu_modes"][gi], float)
                            cv = np.asarray(r["nu_covs"][gi], float).reshape(p, p)
                            sel = idx == gi
                            vals[sel] = rng.multivariate_normal(m, cv, size=int(sel.sum()), method="cholesky")
                        sig = np.exp(vals[:, -1])
                        nu = np.asarray(r["nu_grid"], float)[idx]
                        mat = np.column_stack([vals[:, :-1], sig, nu])
                    else:
                        m = np.asarray(r["mode"], float)
                        cv = np.asarray(r["cov"], float).reshape(p, p)
                        mat = rng.multivariate_normal(m, cv, size=n_draws, method="cholesky")
                    df = pd.DataFrame(mat, columns=out_names)
                    df.insert(0, "draw", np.arange(n_draws, dtype=np.int32))
                    df.insert(0, "chain", np.int32(c))
                    for k in reversed(keys):
                        df.insert(0, k, r[k])
                    parts.append(df)
            if parts:
                yield pd.concat(parts, ignore_index=True)[schema.fieldNames()]
    # one task per model key: repartition the (small) posterior table by key
    src = posterior.select(*cols)
    if keys:
        src = src.repartition(*keys)
    return src.mapInPandas(gen, schema)


def fit_student_t(design: DataFrame, features: Sequence[str], y: str = "y", keys: Sequence[str] = (),
                  prior_sd: float = 0.5, sigma_scale: float = 0.5, nu_rate: float = 0.1,
                  nu_grid: Sequence[float] = NU_GRID, max_iter: int = 100, tol: float = 1e-9):
    """M5: robust regression MAP per key and per nu of the grid by damped Newton steps.

    Per nu the state holds the best point so far with its objective, gradient and curvature, the length of the step and the
    point to try next; a pass evaluates all points to try. A point that is no better is dropped and the step shortened. A key
    has converged when no entry of its gradient exceeds ``tol`` per row, for every nu.

    Returns ``(params, posterior)`` like :func:`fit_logistic`; ``params`` reports
    the highest-posterior nu's mode with Laplace std errors, plus ``nu`` and
    ``sigma`` rows.
    """
    keys, feats = list(keys), list(features)
    names = ["a"] + [f"b_{f}" for f in feats] + ["log_sigma"]
    p, G = len(feats) + 1, len(nu_grid)
    q = p + 1
    prec = np.eye(p) / prior_sd ** 2
    upper = np.triu_indices(p)
    cells = len(upper[0])
    per_stats = 3 + p + cells + p + 1  # rows, objective, d log sigma, gradient, curvature
    # of one nu: rows, best (objective, point, gradient, curvature), length of the step, point to try
    per_state = 2 + q + q + q * q + 1 + q

    def stats(state, X, y):
        out = []
        for g, nu in enumerate(nu_grid):
            point = state[(g + 1) * per_state - q:(g + 1) * per_state]
            s2 = math.exp(2.0 * point[p])
            r = y - X @ point[:p]
            scale = nu * s2 + r * r
            pull = (nu + 1.0) * r / scale
            bend = (nu + 1.0) * (nu * s2 - r * r) / (scale * scale)
            cross = (nu + 1.0) * 2.0 * nu * s2 * r / (scale * scale)
            out += [[len(y), (nu + 1.0) / 2.0 * np.log1p(r * r / (nu * s2)).sum(), pull @ r], X.T @ pull,
                    (X.T @ (X * bend[:, None]))[upper], X.T @ cross, [cross @ r]]
        return np.concatenate([np.asarray(o, float) for o in out])

    def posterior_at(point, sums):
        """Objective (negative log posterior up to a constant of nu and n), gradient and curvature."""
        n, fit, pull_r, pull_x = sums[0], sums[1], sums[2], sums[3:3 + p]
        theta, ls = point[:p], point[p]
        s2 = math.exp(2.0 * ls)
        value = fit + (n - 1.0) * ls + 0.5 * theta @ prec @ theta + s2 / (2.0 * sigma_scale ** 2)
        gradient = np.append(prec @ theta - pull_x, n - 1.0 - pull_r + s2 / sigma_scale ** 2)
        H = np.zeros((q, q))
        H[:p, :p] = _triangle(sums[3 + p:3 + p + cells], p) + prec
        H[:p, p] = H[p, :p] = sums[3 + p + cells:3 + p + cells + p]
        H[p, p] = sums[-1] + 2.0 * s2 / sigma_scale ** 2
        return value, gradient, H

    def advance(held, sums):
        best, point, gradient, H = held[1], held[2:2 + q], held[2 + q:2 + 2 * q], held[2 + 2 * q:2 + 2 * q + q * q].reshape(q, q)
        length, tried = held[-q - 1], held[-q:]
        value, new_gradient, new_H = posterior_at(tried, sums)
        if value <= best + 1e-12 * (1.0 + abs(best)) or not math.isfinite(best):
            best, point, gradient, H, length = value, tried, new_gradient, new_H, min(1.0, 4.0 * length)
        else:
            length = length / 4.0
        size = float(np.abs(gradient).max() / max(sums[0], 1.0))
        step = np.zeros(q)
        if size > tol:
            # Newton with every curvature taken as positive: downhill in all directions, full steps near the mode
            unit = np.sqrt(np.maximum(np.abs(np.diag(H)), 1e-8))
            curvature, axes = np.linalg.eigh(H / np.outer(unit, unit))
            step = -(axes @ ((axes.T @ (gradient / unit)) / np.maximum(np.abs(curvature), 1e-12))) / unit
            step[p] = min(max(step[p], -1.0), 1.0)
        return np.concatenate([[sums[0], best], point, gradient, H.ravel(), [length], point + length * step]), size

    def update(state, sums):
        both = [advance(state[g * per_state:(g + 1) * per_state], sums[g * per_stats:(g + 1) * per_stats]) for g in range(G)]
        return np.concatenate([b[0] for b in both]), max(b[1] for b in both)

    # start at the mean of y and its deviation, with no best point yet
    blocks = _blocks(design, keys, feats, y)
    sums_schema = StructType([blocks.schema[k] for k in keys] + [StructField(c, DoubleType()) for c in ("n", "s", "ss")])

    def target_sums(batches):
        for batch in batches:
            ys = [matrix(b.as_py(), p)[:, 0] for b in batch.column("block")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), *(pa.array([float(f(v)) for v in ys], pa.float64())
                                                     for f in (len, np.sum, lambda v: v @ v))], names=sums_schema.names)

    moments = blocks.mapInArrow(target_sums, sums_schema).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "ss")]).select(
        *keys, (F.col("s") / F.col("n")).alias("m"),
        F.sqrt(F.greatest(F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2), F.lit(0.0))).alias("s"))
    zeros = lambda n: [F.lit(0.0)] * n
    one_nu = F.array(F.lit(0.0), F.lit(math.inf), *zeros(q + q + q * q), F.lit(1.0), F.col("m"), *zeros(p - 1),
                     F.ln(F.greatest("s", F.lit(1e-6))))
    start = moments.where("m is not null").select(*keys, F.flatten(F.array_repeat(one_nu, G)).alias("state"))
    state = iterate(blocks, keys, start, p, G * per_stats, stats, update, max_iter, tol)

    spacing = np.gradient(np.asarray(nu_grid, float))
    doubles, rows_of = ArrayType(DoubleType()), ArrayType(ArrayType(DoubleType()))
    schema = StructType([state.schema[k] for k in keys] + [StructField(n, t) for n, t in (
        ("mode", doubles), ("cov", doubles), ("nu_grid", doubles), ("nu_weight", doubles), ("nu_modes", rows_of),
        ("nu_covs", rows_of))])

    def summary(state):
        weights, modes, covs = [], [], []
        for g, nu in enumerate(nu_grid):
            held = state[g * per_state:(g + 1) * per_state]
            n, H = held[0], held[2 + 2 * q:2 + 2 * q + q * q].reshape(q, q)
            # log posterior density of (a, b, log sigma, nu) at the mode ...
            lp = -held[1] + n * (math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2) - 0.5 * math.log(nu * math.pi)) \
                + math.log(nu_rate) - nu_rate * (nu - 2.0)
            # ... times the volume of its normal approximation and the grid cell of nu
            weights.append(lp - 0.5 * np.linalg.slogdet(H)[1] + math.log(spacing[g]))
            modes.append(held[2:2 + q].tolist())
            covs.append(np.linalg.inv(H).ravel().tolist())
        best = int(np.argmax(weights))
        w = np.exp(np.array(weights) - max(weights))
        return modes[best], covs[best], list(map(float, nu_grid)), (w / w.sum()).tolist(), modes, covs

    def finish(batches):
        for batch in batches:
            found = [summary(np.asarray(s.values, float)) for s in batch.column("state")]
            one, two = pa.list_(pa.float64()), pa.list_(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys),
                 *(pa.array([f[j] for f in found], t) for j, t in enumerate((one, one, one, one, two, two)))], names=schema.names)

    posterior = staged(state.mapInArrow(finish, schema), "posterior").withColumn("names", F.array(*[F.lit(n) for n in names]))
    w = F.col("nu_weight")
    more = posterior.select(*keys, F.inline(F.array(
        F.struct(F.lit("nu").alias("param"), F.col("nu_grid")[F.array_position(w, F.array_max(w)).cast("int") - 1].alias("estimate"),
                 F.lit(None).cast("double").alias("std_error")),
        F.struct(F.lit("sigma").alias("param"), F.exp(F.col("mode")[p]).alias("estimate"),
                 F.lit(None).cast("double").alias("std_error")))))
    return _params(posterior, keys, names).unionByName(more), posterior
