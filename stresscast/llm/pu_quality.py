"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives P are documents labelled good; every document of the corpus is unlabelled web text U; the
class prior is estimated as the share of good ones among the labelled documents that may be learned from. With the
logistic loss the unbiased risk of a linear score f is convex,

    R(f) = prior E_P[loss(f)] + R_neg,   R_neg = E_U[loss(-f)] - prior E_P[loss(-f)],

and is minimised by damped Newton steps. R_neg estimates a mean of losses and must not fall below zero (Kiryo et
al. 2017): a step that would take it below -beta is replaced by the best step along which R_neg stays as it is.
Labels of bad documents are used for the prior alone.

Scale: one pass over the texts gives a table of short feature vectors; each Newton step, all its step sizes
included, is one pass over that table that sums on the executors a fixed number of statistics (the square of the
features). No sample, no cap: P, U, means and deviations cover all rows.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stresscast.llm.common import docs_with, staged

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = b"0123456789"
_STOP = b".,;:?'\"()-"
_MARK = bytes(c for c in range(33, 127) if c not in _UPPER + _LOWER + _DIGIT + _STOP + b"!|")
FEATURES = ("length", "short", "marks", "root_marks", "upper", "digits", "shouts", "bars", "variety", "distinct",
            "repeats", "root_repeats", "word_length", "stops", "copied_lines", "foreign")


def text_features(text: bytes | None) -> list[float]:
    """Bounded statistics of a whole UTF-8 text; null counts as empty."""
    text = text or b""
    words = text.split()
    n, size = max(len(words), 1), max(len(text), 1)

    def share(chars: bytes) -> int:
        return len(text) - len(text.translate(None, chars))

    upper, lower, marks = share(_UPPER), share(_LOWER), share(_MARK) / size
    distinct = len(set(words))
    repeats = sum(map(operator.eq, words, words[1:])) / n
    lines = [x for x in text.split(b"\n") if x]
    return [math.log1p(len(words)) / 10, min(1.0, len(words) / 50), marks, marks ** 0.5, upper / max(upper + lower, 1),
            share(_DIGIT) / size, min(1.0, text.count(b"!") / n), min(1.0, text.count(b"|") / n),
            math.log(distinct + 1) / math.log(len(words) + 1) if words else 1.0, distinct / n if words else 1.0,
            repeats, repeats ** 0.5, min(3.0, sum(map(len, words)) / n / 10), min(1.0, share(_STOP) / n),
            1 - len(set(lines)) / len(lines) if lines else 0.0, (size - len(text.translate(None, bytes(range(128, 256))))) / size]


@dataclass(frozen=True)
class Model:
    """A linear score of standardised features, with how it was reached."""

    weights: tuple[float, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    prior: float
    steps: int
    gradient: float
    negative_risk: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = standardised(features, self.mean, self.scale)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -700, 700)))


def standardised(features: np.ndarray, mean, scale) -> np.ndarray:
    """Standardised features, five deviations at most, and a constant."""
    x = np.clip((features - np.array(mean)) / np.array(scale), -5, 5)
    return np.concatenate((x, np.ones((len(x), 1))), axis=1)


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, x)`` with the feature vector of each document row, as a table of its own."""
    rows = docs_with(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [text_features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return staged(rows.mapInArrow(run, "doc_id long, x array<double>"), "features")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing may be learned from: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sums(marked: DataFrame, weights: np.ndarray, mean, scale) -> np.ndarray:
    """For several weight vectors, per class (U, then P): rows, softplus(f), f, x, s(f) x, and the curvature, summed.

    Each task gives one row of sums; they are added up in one more task and one row comes back.
    """
    k, p = weights.shape
    width = 3 + 2 * p + p * p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 2, width))
        for b in batches:
            x = standardised(b.column(0).flatten().to_numpy().reshape(-1, p - 1), mean, scale)
            positive = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for c, rows in enumerate((x, x[positive])):
                for j, w in enumerate(weights):
                    f = rows @ w
                    s = 1 / (1 + np.exp(-np.clip(f, -700, 700)))
                    total[j, c] += np.concatenate(([len(rows), np.logaddexp(0, f).sum(), f.sum()], rows.sum(axis=0), s @ rows,
                                                   (rows.T @ ((s * (1 - s))[:, None] * rows)).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((b.column(0).flatten().to_numpy().reshape(-1, 2 * k * width).sum(axis=0) for b in batches), np.zeros(2 * k * width))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["v"])

    schema = "v array<double>"
    parts = marked.select("x", "positive").mapInArrow(run, schema).repartition(1).mapInArrow(add, schema).collect()
    return np.array(parts[0].v if parts else np.zeros(2 * k * width)).reshape(k, 2, width)


def fit(features: DataFrame, labels: DataFrame, max_steps: int = 100, ridge: float = 1e-3,
        tolerance: float = 1e-4, beta: float = 1e-3) -> Model:
    """Fit on a feature table and ``labels (doc_id, quality)`` of the rows that may be learned from.

    A document with several labels is good if all say 1. Null labels and ids are no labels. Without documents or
    without any good one the model gives every document the prior. Raises if the steps do not settle.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n, good = known.agg(F.count("*"), F.sum((F.col("quality") == 1).cast("int"))).first()
    prior = ((good or 0) + 1) / (n + 2)
    k = len(FEATURES)
    moments = features.select(*[F.col("x")[i].alias(f"x{i}") for i in range(k)]).agg(
        *[F.avg(f"x{i}") for i in range(k)], *[F.stddev_pop(f"x{i}") for i in range(k)]).first()
    if moments[0] is None:
        moments = [0.0] * (2 * k)
    mean, scale = tuple(moments[:k]), tuple(s if s > 1e-9 else 1.0 for s in moments[k:])
    marked = staged(features.join(known.where("quality = 1").select("doc_id", F.lit(True).alias("positive")), "doc_id", "left")
                    .select("x", F.coalesce("positive", F.lit(False)).alias("positive")), "marked")
    p = k + 1
    penalty = np.full(p, ridge)
    penalty[-1] = 0.0

    def at(trials: list[np.ndarray]) -> list[tuple]:
        """Risk, gradient, curvature, R_neg and its gradient at some weights, in one pass."""
        out = []
        for w, (u, q) in zip(trials, _sums(marked, np.array(trials), mean, scale)):
            if not u[0] or not q[0]:
                return []
            soft, soft_p, mean_p = u[1] / u[0], q[1] / q[0], q[2] / q[0]
            risk = soft - prior * mean_p + penalty @ (w * w) / 2
            gradient = u[3 + p:3 + 2 * p] / u[0] - prior * q[3:3 + p] / q[0] + penalty * w
            curvature = u[3 + 2 * p:].reshape(p, p) / u[0] + np.diag(penalty + 1e-9)
            down = u[3 + p:3 + 2 * p] / u[0] - prior * q[3 + p:3 + 2 * p] / q[0]
            out.append((risk, gradient, curvature, soft - prior * soft_p, down))
        return out

    def model(step: int) -> Model:
        return Model(tuple(w.tolist()), mean, scale, prior, step, float(np.abs(state[1]).max()), float(state[3]))

    w = np.zeros(p)
    w[-1] = math.log(prior / (1 - prior))
    first = at([w])
    if not first:
        return Model(tuple(w.tolist()), mean, scale, prior, 0, 0.0, 0.0)
    state = first[0]
    for step in range(1, max_steps + 1):
        risk, gradient, curvature, negative, down = state
        free = -np.linalg.solve(curvature, gradient)
        side = np.linalg.solve(curvature, down)
        along = free - side * (down @ free) / (down @ side + 1e-300)
        if -gradient @ free < tolerance:
            return model(step)
        # All step sizes of both directions are tried in one pass; the first that serves is taken.
        moves = []
        for move in (free, along):
            most = min(1.0, 10 / float(np.abs(move).max()))
            if -gradient @ move >= tolerance:
                moves += [most * size * move for size in (1, 1 / 2, 1 / 4, 1 / 16, 1 / 64)]
        for move, trial in zip(moves, at([w + m for m in moves])):
            if trial[0] <= risk + 1e-4 * (gradient @ move) and trial[3] >= min(-beta, negative):
                w, state = w + move, trial
                break
        else:  # every step forward would take the negative risk below its bound
            return model(step)
    raise RuntimeError(f"the risk has not settled after {max_steps} steps")


def learnable(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", "quality").where(~held_out(F.col("doc_id")))


def scored(features: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of a feature table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    return features.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per document row; learned from rows that are not held out."""
    features = feature_table(docs)
    found = scored(features, fit(features, learnable(labels)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score_column(model: Model, text: Column) -> Column:
    """Score of a text column, for filters that keep all other columns where they are."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([text_features(t) for t in texts]).reshape(len(texts), -1)))

    return run(text.cast("binary"))
