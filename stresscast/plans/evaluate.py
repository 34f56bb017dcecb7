"""Back-test evaluation (E3-E7) on scored rows ``(keys, date, score, outcome)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresscast.operators.aggregates import crosstab_normalized, describe
from stresscast.operators.auc import exact_auc
from stresscast.operators.joins import attach_row
from stresscast.operators.ranks import exact_quantiles, join_null_safe
from stresscast.operators.windows import rolling
from stresscast.session import staged


def qcut_edges(df: DataFrame, score: str, q: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """F23 edges: linear-interpolated quantiles 0, 1/q, ..., 1 (one row per key), exact and distributed."""
    e = exact_quantiles(df, score, [i / q for i in range(q + 1)], keys, prefix="_e")
    return e.select(*keys, F.array(*[F.col(f"_e{i}") for i in range(q + 1)]).alias("_edges"))


def qcut(df: DataFrame, score: str, q: int = 5, keys: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """equal-frequency bins, right-closed, lowest edge included.

    Adds ``bin`` (0..q-1), ``bin_lo``, ``bin_hi``. NULL scores get no bin. With
    ``strict`` duplicate edges raise, as the source library does; otherwise
    empty bins are simply absent. (``Bucketizer`` is left-closed and ``ntile``
    is rank based, so neither matches.)
    """
    keys = list(keys)
    edges = qcut_edges(df, score, q, keys)
    if strict:
        dup = edges.where(F.size(F.array_distinct("_edges")) < q + 1).limit(1).count()
        if dup:
            raise ValueError("qcut: bin edges are not unique")
    j = df.join(edges, keys, "left") if keys else attach_row(df, edges)
    e = F.col("_edges")
    b = F.lit(None).cast("int")
    for i in range(q - 1, -1, -1):
        b = F.when(F.col(score) <= e[i + 1], F.lit(i)).otherwise(b)
    b = F.when(F.col(score) < e[0], F.lit(None)).otherwise(b)
    return (j.withColumn("bin", b)
             .withColumn("bin_lo", F.when(F.col("bin").isNotNull(), F.get(e, F.col("bin"))))
             .withColumn("bin_hi", F.when(F.col("bin").isNotNull(), F.get(e, F.col("bin") + 1)))
             .drop("_edges"))


def reliability(df: DataFrame, score: str, outcome: str, q: int = 5, keys: Sequence[str] = (),
                strict: bool = True) -> DataFrame:
    """E6 (+A8): observed outcome frequency per score quintile."""
    keys = list(keys)
    b = qcut(df, score, q, keys, strict=strict).where(F.col("bin").isNotNull())
    return b.groupBy(*keys, "bin", "bin_lo", "bin_hi").agg(
        F.avg(F.col(outcome).cast("double")).alias("observed_freq"), F.count(F.lit(1)).cast("bigint").alias("n"))


def alert_table(df: DataFrame, score: str, outcome: str, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """E4 (P13 + A9): alert = score > t (a NULL score gives no alert row), row-normalized."""
    a = df.withColumn("alert", F.when(F.col(score).isNotNull(), F.col(score) > F.lit(threshold)))
    return crosstab_normalized(a, "alert", outcome, (0, 1), keys)


def realized_exceed(ret_col: str, threshold: float = 0.02):
    """Realized |return| above a threshold as 0/1 (NULL return gives NULL)."""
    r = F.col(ret_col)
    return F.when(r.isNotNull(), (F.abs(r) > F.lit(threshold)).cast("int"))


def discrimination(scored: DataFrame, outcomes: DataFrame, score: str, outcome: str, keys: Sequence[str] = (),
                   on: Sequence[str] = ("date",)) -> DataFrame:
    """Scored rows joined to the realized outcomes, the score described per outcome, and the exact AUC beside it.

    One row per key and outcome: count, mean, std, min, quartiles, max, ``auc``, ``n_pos``, ``n_neg``. Rows without a realized
    outcome are in no class and not in the AUC, as in the source; rows without a score count in their class with
    NULL statistics and are not in the AUC.
    """
    keys = list(keys)
    known = outcomes.select(*keys, *on, outcome).where(F.col(outcome).isNotNull())
    both = staged(scored.select(*keys, *on, score).join(known, [*keys, *on]), "scored")
    classes = describe(both, score, [*keys, outcome])
    return join_null_safe(classes, exact_auc(both, score, outcome, keys), keys)


def naive_baseline(df: DataFrame, outcome: str, keys: Sequence[str] = ("pipeline",), order="date",
                   n: int = 30) -> DataFrame:
    """Mean of the previous ``n`` outcomes (full window required), excluding the current row."""
    return df.withColumn("baseline", rolling(F.col(outcome).cast("double"), n, "mean", keys, order, shift=1))


def baseline_vs_model(df: DataFrame, score: str, outcome: str, keys: Sequence[str] = ("pipeline",),
                      order="date", n: int = 30, auc_keys: Sequence[str] = ()) -> DataFrame:
    """E5: AUC of the naive baseline and of the model score on one common row set (§8 Q9)."""
    b = naive_baseline(df, outcome, keys, order, n).where(F.col("baseline").isNotNull() &
                                                          F.col(score).isNotNull() & F.col(outcome).isNotNull())
    ab = exact_auc(b, "baseline", outcome, auc_keys).select(*auc_keys, F.col("auc").alias("auc_baseline"))
    am = exact_auc(b, score, outcome, auc_keys).select(*auc_keys, F.col("auc").alias("auc_model"), "n_pos", "n_neg")
    if auc_keys:
        return ab.join(am, list(auc_keys))
    return attach_row(ab, am)
