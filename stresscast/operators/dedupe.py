"""Keyed de-duplication: keep first / keep last / latest per key.

``row_number`` over the key with a *total* order (explicit tie-breakers), so
the kept row never depends on partition layout (``dropDuplicates`` keeps an
arbitrary row). With ``== 1`` Spark plans a WindowGroupLimit that trims each
partition before the shuffle-side sort, so a hot key does not ship all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence, descending: bool):
    out = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.desc_nulls_last() if descending else col.asc_nulls_last())
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """First row per key by ``order`` ascending."""
    w = Window.partitionBy(*keys).orderBy(*_order(order, False))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Last row per key by ``order`` (i.e. first by ``order`` descending)."""
    w = Window.partitionBy(*keys).orderBy(*_order(order, True))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def ensure_daily(df: DataFrame, keys: Sequence[str] = (), date_col: str = "date",
                 tie_breakers: Sequence = ()) -> DataFrame:
    """Lenient date, drop null dates, one row per (keys, date), last wins.

    "Last" follows ``tie_breakers`` (e.g. an ingest time), without them the other
    columns in their order; the source system's unstable sort made this
    arbitrary (§8 Q12).
    """
    from stresscast.functions.scalar import to_date_lenient
    d = df.withColumn(date_col, to_date_lenient(date_col)).where(F.col(date_col).isNotNull())
    order = list(tie_breakers) or [c for c in d.columns if c != date_col and c not in keys]
    return keep_last(d, list(keys) + [date_col], order)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The latest row per key (``iloc[-1]`` of an ordered frame)."""
    return keep_last(df, keys, order)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K8: keys that occur more than once (empty when the unique-key invariant holds)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))
