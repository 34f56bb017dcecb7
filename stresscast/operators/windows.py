"""Ordered per-series window features.

Every window is partitioned by the series keys (pipeline, ...). Inputs are
daily frames (one row per key and day), so a partition holds at most one row
per calendar day no matter how much raw data fed the frame; aggregate first,
then window.

pandas ``rolling(n, min_periods=m)`` semantics: a value is produced when the
window holds at least ``m`` non-null values (default ``m = n``, so any NULL in
the window or fewer than ``n`` rows gives NULL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stresscast.functions.scalar import safe_ln


def series_window(keys: Sequence[str], order: str | Sequence[str] = "date"):
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*order)


def rolling(col, n: int, fn: str = "mean", keys: Sequence[str] = ("pipeline",), order="date",
            min_periods: int | None = None, shift: int = 0) -> Column:
    """Rolling sum/mean over the last ``n`` rows ending ``shift`` rows back."""
    c = F.col(col) if isinstance(col, str) else col
    m = n if min_periods is None else min_periods
    w = series_window(keys, order).rowsBetween(-(n - 1) - shift, -shift)
    agg = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}[fn](c).over(w)
    return F.when(F.count(c).over(w) >= m, agg)


def rolling_long(col, n: int, fn: str = "mean", keys: Sequence[str] = ("pipeline",), order="date",
                 min_periods: int | None = None, shift: int = 0, scale: int = 12) -> Column:
    """Rolling sum/mean of :func:`rolling` for long windows (W6, W10), O(1) per row whatever ``n`` is.

    The sum and the count over the window are running ones from the first row on, minus the same ``n`` rows back. Both
    frames only ever grow, so Spark adds each row to each once. Sums are decimals with ``scale`` places and 26 digits before
    the point, so the difference is exact for values with so many places (others are rounded to them) and nothing
    of a row stays behind when it leaves the window. NULL and NaN are missing values; beyond 26 digits the sum is an error.
    """
    c = F.col(col) if isinstance(col, str) else col
    m = n if min_periods is None else min_periods
    known = F.when(~F.isnan(c.cast("double")), c.cast(f"decimal({min(38, 26 + scale)},{scale})"))
    w = series_window(keys, order)
    upto, gone = w.rowsBetween(Window.unboundedPreceding, -shift), w.rowsBetween(Window.unboundedPreceding, -n - shift)
    count = F.count(known).over(upto) - F.count(known).over(gone)
    total = F.coalesce(F.sum(known).over(upto) - F.coalesce(F.sum(known).over(gone), F.lit(0)), F.lit(0)).cast("double")
    value = {"mean": total / F.nullif(count, F.lit(0)), "sum": F.when(count > 0, total)}[fn]
    return F.when(count >= m, value)


def lag(col, n: int = 1, keys: Sequence[str] = ("pipeline",), order="date") -> Column:
    """Value ``n`` rows back (previous row, not previous calendar day)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lag(c, n).over(series_window(keys, order))


def log_return(col, keys: Sequence[str] = ("pipeline",), order="date") -> Column:
    """ln(x) - ln(previous row's x); NULL if either side is NULL or not positive."""
    lx = safe_ln(col)
    return lx - F.lag(lx, 1).over(series_window(keys, order))


def add_lags(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("pipeline",), order="date",
             suffix: str = "_lag1", n: int = 1) -> DataFrame:
    return df.withColumns({f"{c}{suffix}": lag(c, n, keys, order) for c in cols})
