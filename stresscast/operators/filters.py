"""Row filters that are more than a ``where``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookback(date_col, as_of, days: int, start=None) -> Column:
    """P10: date >= as_of - days, or >= start when a start is given."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    if start is not None:
        return c >= F.lit(start).cast("date")
    return c >= F.date_sub(F.lit(as_of).cast("date"), int(days))


def clamp_cutoff_days(value, default: int = 1) -> int:
    """P11 argument rule: unparsable -> default (1), negative -> 0."""
    try:
        v = int(value)
    except (TypeError, ValueError):
        return default
    return max(v, 0)


def take_while_newer(rows: DataFrame, time_col: str, cutoff, list_keys: Sequence[str], position) -> DataFrame:
    """Per list (``list_keys``) in ascending ``position`` order, keep rows until the first row
    older than ``cutoff`` (that row and all after it are dropped); rows without a time are
    skipped and do not stop the scan.

    No ordered window: the stop position of each list is ``min(position)`` over its
    older rows (a partially aggregated group-by, so one huge list is combined on
    the mappers), joined back on the list key; rows before it are kept.
    ``position`` is a column name or expression, ascending (use ``-col`` for
    newest-first lists keyed by an increasing id).
    """
    t = F.col(time_col)
    pos = F.col(position) if isinstance(position, str) else position
    older = t.isNotNull() & (t < F.lit(cutoff).cast("date"))
    d = rows.withColumn("_pos", pos)
    stops = d.where(older).groupBy(*list_keys).agg(F.min("_pos").alias("_stop"))
    kept = d.join(stops, list(list_keys), "left")
    return kept.where(t.isNotNull() & (F.col("_stop").isNull() | (F.col("_pos") < F.col("_stop")))) \
        .drop("_pos", "_stop")


def time_split(df: DataFrame, date_col: str, train_end) -> tuple[DataFrame, DataFrame]:
    """train = date <= end, test = date > end."""
    e = F.lit(train_end).cast("date")
    return df.where(F.col(date_col) <= e), df.where(F.col(date_col) > e)


def above(col, threshold: float) -> Column:
    """Strict threshold; NULL stays NULL (NaN never reaches here, §9 T3)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNotNull(), c > F.lit(threshold))


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """K9: good / quarantine split by one predicate (NULL counts as not good)."""
    ok = F.coalesce(predicate, F.lit(False))
    return df.where(ok), df.where(~ok)
