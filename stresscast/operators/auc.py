"""Exact ROC AUC as a distributed DataFrame plan (A10).

AUC = sum over positives of (negatives with a lower score + half the negatives
with an equal score) / (P * N), the rank statistic with ties at mid-rank. The
negatives below a score are its range's offset within the key plus a running sum
inside the range (``operators/ranks.py``); the input is read once, nothing is
collected and no window is unbounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresscast.operators.ranks import RANGE, counted_ranges, join_null_safe, range_totals


def exact_auc(df: DataFrame, score: str = "score", label: str = "outcome", keys: Sequence[str] = ()) -> DataFrame:
    """One row per key: ``auc``, ``n_pos``, ``n_neg``. NULL scores/labels are left out.

    AUC is NULL when a key has only one class (undefined). Without keys an input without rows gives one row.
    """
    keys = list(keys)
    y = F.col(label).cast("long")
    table = counted_ranges(df.where(F.col(label).isNotNull()), keys, score, {"_p": F.sum(y), "_n": F.sum(1 - y)}, ["_n"])
    offsets = range_totals(table, keys, ["_n"]).select(*keys, RANGE, "_n_before")
    rows = join_null_safe(table, offsets, [*keys, RANGE])
    wins = F.col("_p") * (F.col("_n_before") + F.col("_n_below") + F.col("_n") * 0.5)
    g = rows.groupBy(*keys).agg(F.sum(wins).alias("_u"), F.sum("_p").alias("n_pos"), F.sum("_n").alias("n_neg"))
    return g.select(*keys, F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                                  F.col("_u") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"),
                    F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg"))
