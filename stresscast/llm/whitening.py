"""Whitening of embeddings by their leading principal components, found with the FEAST contour method.

Entries become integers (``floor(scale * entry) + shift``), so sums, centred products and the covariance come from exact
integer arithmetic, whatever the order of rows and tasks. The fit list holds each distinct vector once; it is written in
the shared folder and read by three passes that each send one small row set per task: sums, centred products, and the
covariance of the whitened fit list, which is measured and not assumed. Only numbers of the size of the covariance (dimensions squared) reach
the driver and travel back in the task closure; vectors never do.

On the covariance V: Sturm counts of its tridiagonal form are inertia counts, the number of eigenvalues above a point;
bisection with them places contours in the gaps between groups of a few eigenvalues. For each contour the
spectral projector is applied to a random block by Gauss-Legendre quadrature of ``(zI - V)^-1``, Rayleigh-Ritz in its
range gives eigenpairs, and both are repeated until residuals are at rounding level. The number of pairs found between two
ends must be the difference of the inertia counts there; if not, the block grows, and a fit that never agrees raises.

Rows are dropped whose vector is null, empty, holds null or non-finite entries, or an entry so large (2^40 after
scaling) that the exact sums would not fit; of vectors of several lengths those of the most common one are kept (of equally common
ones the longest). Repeated rows count once in the fit and each in the result; null ids and extra columns do not matter.
Components without variance do not exist: the result has ``min(components, rank)`` a row, none for an empty table or a
single distinct vector. Eigenvectors of equal eigenvalues are any orthonormal basis of their space. A ``deviation`` that
a long cannot hold is null.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stresscast.llm.common import docs_with, staged

#: Scaled entries from here on count as non-finite.
TOO_LARGE = 1 << 40
#: Quadrature nodes on the half circle of a contour.
NODES = 16


# --- integers ------------------------------------------------------------------------------------------------------

def integer_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows with a usable vector: ``vec_id`` and ``y``, the floors of the scaled entries as packed 64-bit integers."""
    vectors = docs_with(vectors, "vec_id", "embedding")
    schema = T.StructType([vectors.schema["vec_id"], T.StructField("y", T.BinaryType())])

    def encode(batches):
        for batch in batches:
            column = batch.column("embedding")
            usable = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            column = column.take(pa.array(usable))
            sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            entries = column.flatten()
            scaled = scale * entries.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
            bad = ~(np.abs(scaled) < TOO_LARGE)
            y = np.floor(np.where(bad, 0.0, scaled)).astype("<i8")
            ends = np.cumsum(sizes)
            n_bad = np.concatenate([[0], np.cumsum(bad)])
            keep = np.flatnonzero((sizes > 0) & (n_bad[ends] == n_bad[ends - sizes]))
            raw = y.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(usable[keep])),
                 pa.array([raw[8 * (ends[k] - sizes[k]):8 * ends[k]] for k in keep], pa.binary())], names=schema.names)

    return vectors.mapInArrow(encode, schema)


def _matrix(batch, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("y").to_pylist()), "<i8").reshape(-1, dims)


def _exact(values: dict) -> pa.RecordBatch:
    """Rows (i, j, value) of Python integers as decimals without fraction."""
    keys = sorted(values)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
         pa.array([Decimal(int(values[k])) for k in keys], pa.decimal128(38, 0))], names=["i", "j", "value"])


_ENTRIES = "i int, j int, value decimal(38,0)"


def column_sums(fit: DataFrame, dims: int) -> list[int]:
    """Exact sum of every dimension."""
    def add(batches):
        total = np.zeros(dims, object)
        for batch in batches:
            total += _matrix(batch, dims).sum(0).astype(object)  # 2^40 times a batch of rows fits 64 bits
        yield _exact({(k, 0): v for k, v in enumerate(total)})

    rows = fit.select("y").mapInArrow(add, _ENTRIES).groupBy("i").agg(F.sum("value").alias("value")).collect()
    return [int(r["value"]) for r in sorted(rows)]


def exact_products(y: np.ndarray) -> np.ndarray:
    """Sum of outer products of integer rows, as Python integers: products of 20-bit limbs are exact in doubles."""
    limbs, rest, weights = [], y, []
    while True:
        low = rest & ((1 << 20) - 1) if np.abs(rest).max(initial=0) >= 1 << 20 else rest
        limbs.append(low.astype(float))
        weights.append(20 * len(weights))
        if low is rest:
            break
        rest = rest >> 20
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for a, s in zip(limbs, weights):
        for b, t in zip(limbs, weights):
            total += (a.T @ b).astype(np.int64).astype(object) << (s + t)
    return total


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance over the fit list, divisor ``n``: correctly rounded from exact centred products.

    Rows are centred at the integers next to the means; what these are off is taken out as an exact fraction.
    """
    dims = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    off = [s - n * c for s, c in zip(sums, centre)]

    def multiply(batches):
        total = np.zeros((dims, dims), object)
        for batch in batches:
            y = _matrix(batch, dims) - np.array(centre, np.int64)
            for at in range(0, len(y), 4096):  # 2^40 times 4096 is exact in doubles
                total += exact_products(y[at:at + 4096])
        yield _exact({(i, j): total[i, j] for i in range(dims) for j in range(i + 1)})

    rows = fit.select("y").mapInArrow(multiply, _ENTRIES).groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    found = np.zeros((dims, dims))
    for i, j, value in rows:
        found[i, j] = found[j, i] = (n * int(value) - off[i] * off[j]) / (n * n)
    return found


# --- FEAST ---------------------------------------------------------------------------------------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix (Householder reflections)."""
    a = v.copy()
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size > 0:
            x /= size
            a[k + 1:, :] -= 2 * np.outer(x, x @ a[k + 1:, :])
            a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia_above(form: tuple[np.ndarray, np.ndarray], points) -> np.ndarray:
    """Number of eigenvalues above each point: positive pivots of the shifted tridiagonal form."""
    diagonal, beside = form
    points = np.atleast_1d(np.asarray(points, float))
    tiny = np.finfo(float).tiny ** 0.5
    pivot, count = np.ones_like(points), np.zeros(len(points), int)
    for k, d in enumerate(diagonal):
        pivot = d - points - (beside[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def approximate_values(form, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues by bisection on inertia counts, falling."""
    diagonal, beside = form
    reach = np.zeros_like(diagonal)
    reach[:-1] += np.abs(beside)
    reach[1:] += np.abs(beside)
    low, high = np.full(count, (diagonal - reach).min()), np.full(count, (diagonal + reach).max())
    rank = np.arange(1, count + 1)
    for _ in range(60):
        middle = (low + high) / 2
        above = inertia_above(form, middle) >= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def contour_ends(values: np.ndarray, wanted: int, group: int = 6) -> list[int]:
    """Where to cut falling eigenvalues into groups: after so many, at the widest gap within reach."""
    ends, at, scale = [], 0, abs(values[0])
    while at < wanted:
        reach = range(min(at + 2, wanted), min(at + group, wanted) + 1) if at + group < wanted else range(
            wanted, min(wanted + group, len(values)) + 1)
        gap = lambda k: np.inf if k == len(values) else values[k - 1] - values[k]  # noqa: B023, E731
        best = max(reach, key=gap)
        while gap(best) < 1e-6 * scale:  # equal eigenvalues stay on one side
            best += 1
        ends.append(best)
        at = best
    return ends


def contour_pairs(v: np.ndarray, low: float, high: float, expected: int, seed: int = 7):
    """All ``expected`` eigenpairs of ``v`` between ``low`` and ``high``."""
    dims, scale = len(v), np.linalg.norm(v, 2)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(-0.5j * np.pi * (nodes - 1))
    centre, radius = (low + high) / 2, (high - low) / 2
    width = min(dims, expected + expected // 2 + 4)
    while True:
        block = np.random.default_rng(seed).standard_normal((dims, width))
        before = np.inf
        for _ in range(40):
            projected = sum(w / 2 * (radius * t * np.linalg.solve((centre + radius * t) * np.eye(dims) - v, block)).real
                            for w, t in zip(weights, turn))
            basis = np.linalg.qr(projected)[0]
            values, turns = np.linalg.eigh(basis.T @ v @ basis)
            block = basis @ turns
            inside = (values > low) & (values < high)
            residual = np.linalg.norm(v @ block[:, inside] - block[:, inside] * values[inside], axis=0).max(initial=0)
            # at rounding level, or as near to it as it gets
            if inside.sum() == expected and (residual <= 4e-15 * scale or before <= 2 * residual <= 1e-11 * scale):
                return values[inside], block[:, inside]
            before = residual if inside.sum() == expected else np.inf
        if width == dims:
            raise RuntimeError(f"{inside.sum()} of {expected} eigenvalues found between {low} and {high}")
        width = min(dims, 2 * width)


def feast(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``components`` largest positive eigenvalues (falling) and their unit eigenvectors in columns."""
    form = tridiagonal(v)
    values = approximate_values(form, len(v))
    positive = int((values > 1e-13 * max(np.trace(v), 0)).sum()) if len(v) else 0
    wanted = min(components, positive)
    if wanted == 0:
        return np.zeros(0), np.zeros((len(v), 0))
    margin = 1e-3 * values[0]
    high, done, blocks = values[0] + margin, 0, []
    for end in contour_ends(values, wanted):
        low = (values[end - 1] + values[end]) / 2 if end < len(values) else values[-1] - margin
        expected = int(inertia_above(form, low)[0] - inertia_above(form, high)[0])
        if expected != end - done:
            raise RuntimeError("inertia counts disagree with the bisection")
        blocks.append(contour_pairs(v, low, high, expected)[1])
        high, done = low, end
    basis = np.linalg.qr(np.hstack(blocks))[0]  # one Rayleigh-Ritz step over all groups makes them orthogonal
    found, turns = np.linalg.eigh(basis.T @ v @ basis)
    first = np.argsort(-found)[:wanted]
    return found[first], basis @ turns[:, first]


# --- result --------------------------------------------------------------------------------------------------------

def identity_error(fit: DataFrame, n: int, sums: list[int], project: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, from the whitened rows themselves."""
    dims, k = project.shape
    centre = [(2 * s + n) // (2 * n) for s in sums]
    off = np.array([(s - n * c) / n for s, c in zip(sums, centre)])

    def add(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = (_matrix(batch, dims) - np.array(centre, np.int64) - off) @ project
            total[:k] += w.T @ w
            total[k] += w.sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k + 1, dtype=np.int32), k)), pa.array(np.tile(np.arange(k, dtype=np.int32), k + 1)),
             pa.array(total.ravel())], names=["i", "j", "value"])

    rows = fit.select("y").mapInArrow(add, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value")).collect()
    total = np.zeros((k + 1, k))
    for i, j, value in rows:
        total[i, j] = value
    mean = total[k] / n
    return float(np.abs(total[:k] / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Per usable row and component: ``vec_id``, ``component`` (from 1), ``n`` (vectors of the fit list), ``deviation``
    (exact sum over dimensions of ``(n*x - S)^2``), ``whitened``, ``explained``, ``identity_error``.

    ``shift`` moves every ``x`` and every mean alike, so it cancels out of all results and is never added.
    """
    rows = integer_rows(vectors, scale)
    every = staged(rows.groupBy("y").agg(F.count(F.lit(1)).alias("copies")), "vectors")
    lengths = every.groupBy((F.length("y") / 8).cast("int").alias("dims")).agg(
        F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("rows"), F.desc("dims")).limit(1).collect()
    schema = T.StructType([rows.schema["vec_id"], *(T.StructField(c, t) for c, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType())))])
    if not common:
        return vectors.sparkSession.createDataFrame([], schema)
    dims, n = common[0]["dims"], common[0]["n"]
    of_length = F.length("y") == 8 * dims
    fit = every.where(of_length)
    sums = column_sums(fit, dims)
    v = covariance(fit, n, sums)
    values, axes = feast(v, components)
    if not len(values):
        return vectors.sparkSession.createDataFrame([], schema)
    project = axes / np.sqrt(values)
    error = identity_error(fit, n, sums, project)
    explained = values / np.trace(v)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    off = [s - n * c for s, c in zip(sums, centre)]
    k = len(values)

    def deviations(y: np.ndarray) -> list:
        """Exact sums of squares of ``n*y - off`` for rows already centred at integers."""
        if (n * (int(np.abs(y).max(initial=0)) + 1)) ** 2 * dims < 1 << 63:
            return ((n * y - np.array(off, np.int64)) ** 2).sum(1).tolist()
        found = ((n * y.astype(object) - np.array(off, object)) ** 2).sum(1)
        return [d if d < 1 << 63 else None for d in found.tolist()]

    def score(batches):
        for batch in batches:
            m = batch.num_rows
            y = _matrix(batch, dims) - np.array(centre, np.int64)
            w = (y - np.array(off, float) / n) @ project
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                 pa.array(deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(w.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], names=schema.names)

    return rows.where(of_length).mapInArrow(score, schema)
