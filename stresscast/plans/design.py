"""Design matrices and forecast inputs.

All features are ordered windows per pipeline over the day-grain model frame.
Per-pipeline statistics (z-score means/stds) are window aggregates over the
same ``partitionBy(keys)``: Spark reuses the partitioning of the lag windows,
so the whole design is one shuffle on the keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stresscast.operators.joins import attach_row
from stresscast.operators.windows import lag, rolling, rolling_long
from stresscast.operators.zscore import scaler_std_b, z_policy_a, z_policy_b


@dataclass(frozen=True)
class FeatureSpec:
    """Ordered preference per feature, resolved against the frame's columns.

    ``features`` maps model feature name -> candidate source columns (first
    present wins); features with no present column are skipped; an empty
    result is an error, as is a missing target.
    """
    target: str = "stress_event"
    features: dict = field(default_factory=lambda: {
        "hdd_lag1": ("hdd_median", "hdd_mean"),
        "storage_lag1": ("working_gas_bcf",),
        "cap_avail_lag1": ("all_qty_avail_median",),
        "notices_lag1": ("notice_active_count",),
    })

    def resolve(self, columns: Sequence[str]) -> dict[str, str]:
        if self.target not in columns:
            raise KeyError(f"missing target column {self.target!r}")
        out = {}
        for name, cands in self.features.items():
            for c in cands:
                if c in columns:
                    out[name] = c
                    break
        if not out:
            raise ValueError("no usable predictors found")
        return out


STRESS_SPEC = FeatureSpec()


def _stats_window(keys: Sequence[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))


def stress_design(frame: DataFrame, keys: Sequence[str] = ("pipeline",), spec: FeatureSpec = STRESS_SPEC,
                  with_scalers: bool = False, scale_inputs: bool = True, keep_nulls: bool = False):
    """M2: y = target; lag-1 predictors; rows with any NULL dropped; z-score policy A per key.

    ``scale_inputs=False`` gives the raw lagged features, with ``keep_nulls`` on every row of the frame.

    Scalers are kept under the lagged names. Returns the design frame (and the
    scaler table as ``keys, feature, mean, std`` when ``with_scalers``).
    """
    keys = list(keys)
    src = spec.resolve(frame.columns)
    d = frame.select(*keys, "date", F.col(spec.target).cast("int").alias("y"),
                     *[lag(c, 1, keys).alias(n) for n, c in src.items()])
    if not (keep_nulls and not scale_inputs):
        d = d.dropna(subset=["y", *src])
    if not scale_inputs:
        return d
    w = _stats_window(keys)
    stats = {n: (F.avg(n).over(w), F.stddev_pop(n).over(w)) for n in src}
    out = d.select(*keys, "date", "y", *[z_policy_a(n, m, s).alias(n) for n, (m, s) in stats.items()],
                   *[m.alias(f"{n}__mean") for n, (m, _) in stats.items()],
                   *[s.alias(f"{n}__std") for n, (_, s) in stats.items()])
    design = out.select(*keys, "date", "y", *src)
    if not with_scalers:
        return design
    sc = out.groupBy(*keys).agg(*[F.first(f"{n}__{k}").alias(f"{n}__{k}") for n in src for k in ("mean", "std")])
    sc = sc.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(f"{n}__mean").alias("mean"),
                 F.when(F.col(f"{n}__std") > 1e-8, F.col(f"{n}__std")).otherwise(1.0).alias("std"))
        for n in src])).alias("_s")).select(*keys, "_s.*")
    return design, sc


VOL_FEATURES = ("op", "persist", "hdd", "storage")


def vol_lagged(frame: DataFrame, keys: Sequence[str] = ("pipeline",)) -> DataFrame:
    """The volatility features of every row of the frame before any scaling or dropping: ``y`` = |hh_ret|, ``op``,
    ``persist`` (7-day stress days), ``hdd`` (5-day mean) and ``level`` (working gas), all but y by one row.

    Operational stress is the first of stress_event and critical_active that the frame has, NULL as 0.
    """
    keys = list(keys)
    if "hh_ret" not in frame.columns:
        raise KeyError("vol_design requires hh_ret")
    hdd_col = "hdd_median" if "hdd_median" in frame.columns else "hdd_mean"
    op_src = [c for c in ("stress_event", "critical_active") if c in frame.columns][:1]
    op = F.coalesce(*[F.col(c).cast("int") for c in op_src], F.lit(0))
    base = frame.select(*keys, "date", F.abs("hh_ret").alias("y"), op.alias("op_stress"), hdd_col, "working_gas_bcf")
    base = base.select(*keys, "date", "y", "op_stress", "working_gas_bcf",
                       rolling("op_stress", 7, "sum", keys, min_periods=1).alias("stress_days_7d"),
                       rolling(hdd_col, 5, "mean", keys, min_periods=1).alias("hdd_5d"))
    return base.select(*keys, "date", "y",
                       lag("op_stress", 1, keys).cast("double").alias("op"),
                       lag("stress_days_7d", 1, keys).cast("double").alias("persist"),
                       lag("hdd_5d", 1, keys).alias("hdd"),
                       lag("working_gas_bcf", 1, keys).alias("level"))


def storage_from_level(lagged: DataFrame, frame: DataFrame, keys: Sequence[str] = ("pipeline",)) -> DataFrame:
    """Replaces ``level`` by ``storage``, its z-score (policy B) with the mean and deviation of ``frame`` per key."""
    keys = list(keys)
    stats = frame.groupBy(*keys).agg(F.avg("working_gas_bcf").alias("_m"), F.stddev_pop("working_gas_bcf").alias("_s"))
    z = F.when(F.col("level").isNotNull(), z_policy_b("level", "_m", "_s"))
    joined = lagged.join(stats, keys, "left") if keys else attach_row(lagged, stats)
    return joined.withColumn("storage", z).drop("level", "_m", "_s")


def vol_design(frame: DataFrame, keys: Sequence[str] = ("pipeline",), with_scalers: bool = False,
               scale_inputs: bool = True):
    """M4: y = |hh_ret|; op stress, 7-day stress days, 5-day HDD mean, storage z (policy B
    over the whole frame); all lag-1; NULL rows dropped; persist/hdd/storage z-scored
    again with policy B; op left as is."""
    keys = list(keys)
    lagged = storage_from_level(vol_lagged(frame, keys), frame, keys).dropna(subset=["y", *VOL_FEATURES])
    if not scale_inputs:
        return lagged
    w = _stats_window(keys)
    zc = ("persist", "hdd", "storage")
    stats = {c: (F.avg(c).over(w), F.stddev_pop(c).over(w)) for c in zc}
    out = lagged.select(*keys, "date", "y", "op", *[z_policy_b(c, m, s).alias(c) for c, (m, s) in stats.items()],
                        *[m.alias(f"{c}__mean") for c, (m, _) in stats.items()],
                        *[s.alias(f"{c}__std") for c, (_, s) in stats.items()])
    design = out.select(*keys, "date", "y", *VOL_FEATURES)
    if not with_scalers:
        return design
    sc = out.groupBy(*keys).agg(*[F.first(f"{c}__{k}").alias(f"{c}__{k}") for c in zc for k in ("mean", "std")])
    sc = sc.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"),
                 scaler_std_b(f"{c}__std").alias("std")) for c in zc])).alias("_s")).select(*keys, "_s.*")
    return design, sc


def forecast_inputs(frame: DataFrame, keys: Sequence[str] = ("pipeline",), latest_only: bool = False) -> DataFrame:
    """Op, persist, hdd, storage as of every row (or only the latest row per key).

    op = 3-row mean of stress_event, persist = 3-row mean of |hh_ret| (both need a
    full window), hdd = hdd_median, storage = level minus the 1095-row mean
    (full window, so NULL with fewer rows, §8 Q6).
    """
    keys = list(keys)
    d = frame.select(
        *keys, "date",
        rolling("stress_event", 3, "mean", keys).alias("op"),
        rolling(F.abs("hh_ret"), 3, "mean", keys).alias("persist"),
        F.col("hdd_median").alias("hdd"),
        (F.col("working_gas_bcf") - rolling_long("working_gas_bcf", 365 * 3, "mean", keys)).alias("storage"))
    if latest_only:
        from stresscast.operators.dedupe import latest
        d = latest(d, keys, ["date"])
    return d
