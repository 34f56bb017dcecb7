"""Join helpers (J1-J11) and the broadcast policy.

Policy: a side is broadcast explicitly only when its size is bounded by
construction (one row of statistics, a parameter table of ``n_draws`` rows);
everything else is left to AQE, which measures the shuffled size at run time
and switches a sort-merge join to a broadcast join only below
``spark.sql.adaptive.autoBroadcastJoinThreshold``, keeping the shuffle join
otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a single-row table (e.g. global statistics) to every row.

    The row is a scalar subquery: it is computed once and becomes a constant of the projection. An empty table
    gives NULLs, more than one row is an error.
    """
    row = one_row.select(F.struct(*one_row.columns).alias("_row")).scalar()
    return df.withColumn("_row", row).select(*df.columns, *[F.col("_row")[c].alias(c) for c in one_row.columns])


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str] | str, how: str = "left") -> DataFrame:
    """Dictionary lookup; unmatched rows keep NULL attributes (the source used ``{}``)."""
    return df.join(table, keys if isinstance(keys, str) else list(keys), how)


def semi_filter(df: DataFrame, members: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Keep rows whose key is in ``members`` (left semi join; no duplicates added)."""
    return df.join(members, keys if isinstance(keys, str) else list(keys), "left_semi")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union of frames whose columns differ; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
