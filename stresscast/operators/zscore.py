"""The three z-score policies of the source models.

Statistics are fitted with one grouped aggregate per key (partial aggregation,
no ordered window) and joined back; the scaler table has one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stresscast.functions.scalar import ZSCORE_EPS
from stresscast.operators.aggregates import fit_scalers
from stresscast.operators.joins import attach_row


def z_policy_a(x, mean, std, eps: float = ZSCORE_EPS) -> Column:
    """F16: (x - mean) / std, dividing by 1 when std <= eps or NULL."""
    x, mean, std = (F.col(v) if isinstance(v, str) else v for v in (x, mean, std))
    return (x - mean) / F.when(std > F.lit(eps), std).otherwise(F.lit(1.0))


def z_policy_b(x, mean, std) -> Column:
    """zeros for every row when std is 0 or NULL, else (x - mean) / std."""
    x, mean, std = (F.col(v) if isinstance(v, str) else v for v in (x, mean, std))
    return F.when(std.isNull() | (std == 0), F.lit(0.0)).otherwise((x - mean) / std)


def scaler_std_b(std) -> Column:
    """Scaler kept by policy B: std as is, 1 when it was NULL (NaN)."""
    s = F.col(std) if isinstance(std, str) else std
    return F.coalesce(s, F.lit(1.0))


def z_policy_c(x, mean, std) -> Column:
    """F18 (scoring side): 0 when std is 0 or NULL, else (x - mean) / std."""
    return z_policy_b(x, mean, std)


def standardize(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), policy: str = "a",
                out_suffix: str = "_z", stats: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Fit (or reuse ``stats``) and apply a policy; returns (frame, scaler table).

    Keyed statistics are window aggregates over ``partitionBy(keys)`` (meant for
    day-grain frames, where a key holds at most one row per day); given
    ``stats`` (one row per key) are joined on the keys; global statistics (no
    keys) are one aggregate row attached to every row. The returned scaler
    table is lazy and costs nothing unless used.
    """
    keys = list(keys)
    fn = {"a": z_policy_a, "b": z_policy_b, "c": z_policy_c}[policy]
    if stats is None and keys:
        # keyed statistics as partition-window aggregates: one pass over the frame, no self-join
        w = Window.partitionBy(*keys)
        j = df.select("*", *[F.avg(c).over(w).alias(f"{c}__mean") for c in cols],
                      *[F.stddev_pop(c).over(w).alias(f"{c}__std") for c in cols])
        st = fit_scalers(df, cols, keys)
    else:
        st = stats if stats is not None else fit_scalers(df, cols, keys)
        j = _attach(df, st, keys)
    out = j.withColumns({f"{c}{out_suffix}": fn(c, f"{c}__mean", f"{c}__std") for c in cols})
    return out.drop(*[f"{c}__{s}" for c in cols for s in ("mean", "std")]), st


def _attach(df: DataFrame, st: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the scaler row(s); with no keys the one global row is attached to every row."""
    if keys:
        return df.join(st, list(keys), "left")
    return attach_row(df, st)
