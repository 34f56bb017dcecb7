"""Posterior scoring (M7, M8; J10 without a cross product).

Every point needs every posterior draw of its model. The draws of a model become
one row with one packed array, points become blocks of rows of one model
(``plans/blocks.py``), and blocks are joined to models by key: a block carries one copy of the
draws, whatever its number of points, and a hot model is many blocks in any number of
tasks. Spark broadcasts the models while they are small and sorts both sides beyond that. Blocks
are scored in Arrow batches as (points x draws) numpy blocks, chunk by chunk; no
group of points is held in memory. A global model is the case without keys.

Student-t noise (M8) comes from the draws (a column of fixed variates) or is made
from a hash of (seed, point, draw), so it does not depend on partitions or order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stresscast.operators.ranks import join_null_safe
from stresscast.plans.blocks import key_blocks, matrix

#: Points of a numpy block.
CHUNK = 128


def _logit_block(X: np.ndarray, a: np.ndarray, B: Sequence[np.ndarray]) -> np.ndarray:
    """a + b_1 x_1 + b_2 x_2 + ... summed left to right (same order as the source)."""
    L = np.broadcast_to(a, (X.shape[0], a.shape[0])).copy()
    for j, b in enumerate(B):
        L = L + X[:, j:j + 1] * b[None, :]
    return L


def hashed_uniforms(seeds: np.ndarray, n: int, stream: int) -> np.ndarray:
    """(seeds x n) numbers in (0, 1), a function of (seed, position, stream) only: the splitmix64 output function."""
    at = np.arange(2 * stream + 1, 2 * stream + 2 * n + 1, 2, dtype=np.uint64)[None, :]
    z = seeds.astype(np.int64).view(np.uint64)[:, None] + at * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(12)).astype(float) + 0.5) * 2.0 ** -52


def student_t(seeds: np.ndarray, nu: np.ndarray) -> np.ndarray:
    """(seeds x draws) Student-t variates with ``nu`` degrees per draw, by Bailey's polar form of two uniforms."""
    u, v = (hashed_uniforms(seeds, len(nu), stream) for stream in (0, 1 << 40))
    return np.sqrt(nu * np.expm1(-2.0 / nu * np.log(u))) * np.cos(2.0 * np.pi * v)


def exceed_probs(X: np.ndarray, draws: Mapping, feats: Sequence[str], kind: str, threshold: float,
                 intercept: str = "a", coef_prefix: str = "b_", sigma: str = "sigma", nu: str = "nu",
                 min_nu: float = 2.1, seeds: np.ndarray | None = None, variate: str | None = None) -> np.ndarray:
    """P(p > t) (kind='stress') or P(y > t) (kind='vol') per point, over the draws (a column per name)."""
    column = lambda name: np.asarray(draws[name], float)
    a, B = column(intercept), [column(f"{coef_prefix}{f}") for f in feats]
    out = np.empty(X.shape[0])
    for s in range(0, X.shape[0], CHUNK):
        L = _logit_block(X[s:s + CHUNK], a, B)
        if kind == "stress":
            over = 1.0 / (1.0 + np.exp(-L)) > threshold
        else:
            t = column(variate)[None, :] if variate else student_t(seeds[s:s + CHUNK], np.maximum(column(nu), float(min_nu)))
            over = L + column(sigma)[None, :] * t > threshold
        out[s:s + CHUNK] = over.mean(axis=1) if len(a) else np.nan
    return out


def model_rows(draws: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per model: its draws, in the order of chain and draw, as one array of doubles (row-major)."""
    order = [c for c in ("chain", "draw") if c in draws.columns]
    one = F.struct(*order, *[F.col(c).cast("double").alias(f"_d{i}") for i, c in enumerate(columns)])
    values = lambda s: F.array(*[s[f"_d{i}"] for i in range(len(columns))])
    return draws.groupBy(*keys).agg(F.flatten(F.transform(F.sort_array(F.collect_list(one)), values)).alias("_draws"))


def score_points(points: DataFrame, draws: DataFrame, features: Sequence[str], kind: str = "stress",
                 threshold: float = 0.30, keys: Sequence[str] = (), id_cols: Sequence[str] = ("date",),
                 out_col: str = "prob", null_as_zero: bool = False, seed: int = 0,
                 intercept: str = "a", coef_prefix: str = "b_", min_nu: float = 2.1, strict: bool = False,
                 variate: str | None = None) -> DataFrame:
    """Score every point against the posterior draws of its model.

    Features without a coefficient in ``draws`` are skipped (``strict`` raises
    instead, §8 Q3). A point with a NULL used feature scores NULL, or with
    ``null_as_zero`` 0.0 like the source (NaN > t is false); a point whose model has no draws scores NULL.
    ``variate`` names a column of ``draws`` that holds the noise of the draw (kind='vol').
    """
    keys, id_cols = list(keys), list(id_cols)
    used = [f for f in features if f"{coef_prefix}{f}" in draws.columns]
    if strict and len(used) != len(features):
        raise KeyError(f"no coefficient for {sorted(set(features) - set(used))}")
    noise = [] if kind != "vol" else ["sigma", variate] if variate else ["sigma", "nu"]
    columns = [intercept, *[f"{coef_prefix}{f}" for f in used], *noise]
    pcols = [*keys, *id_cols]
    own = keys if keys and all(k in draws.columns for k in keys) else []
    seeded = F.xxhash64(F.lit(seed), *[F.col(c).cast("string") for c in pcols]).alias("_seed")
    # a constant first column keeps the number of points when no feature is used
    pts = points.select(*pcols, F.lit(1.0).alias("_one"), *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(used)],
                        seeded)
    blocks = key_blocks(pts, own, ["_one", *[f"_x{i}" for i in range(len(used))]], [*pcols, "_seed"])
    models = model_rows(draws, own, columns)
    schema = StructType([pts.schema[c] for c in pcols] + [StructField(out_col, DoubleType())])

    def score(batches):
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                X = matrix(batch.column("block")[i].as_py(), len(used) + 1)[:, 1:]
                packed = batch.column("_draws")[i]
                if not packed.is_valid:
                    found.append(np.full(len(X), np.nan))
                    continue
                m = np.asarray(packed.values, float).reshape(-1, len(columns))
                p = exceed_probs(X, dict(zip(columns, m.T)), used, kind, threshold, intercept, coef_prefix, min_nu=min_nu,
                                 seeds=np.asarray(batch.column("__seed")[i].values), variate=variate)
                found.append(p if null_as_zero else np.where(np.isnan(X).any(axis=1), np.nan, p))
            p = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(f"_{c}").flatten() for c in pcols),
                                              pa.array(p, pa.float64(), mask=np.isnan(p))], names=schema.names)

    return join_null_safe(blocks, models, own, "left").mapInArrow(score, schema)
