"""Calendar alignment: weekly series to daily (W7, J8) and date ranges.

An as-of alignment ("each day takes the latest weekly value") is expressed as
``lead`` to the next weekly date plus ``explode(sequence(...))``: every output
day is generated exactly once, by the weekly row that covers it, so the plan
is one shuffle on the series keys and a map-side explode. No calendar table,
no range join, no cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stresscast.operators.dedupe import ensure_daily


def weekly_to_daily_ffill(weekly: DataFrame, value_cols: Sequence[str], keys: Sequence[str] = (),
                          date_col: str = "date", tie_breakers: Sequence = ()) -> DataFrame:
    """Daily rows from the first to the last weekly date of each series.

    NULLs inside the range take the last non-null value (forward fill, no
    back fill, nothing beyond the last weekly date). Duplicate weekly dates
    keep the last row (§8 Q13). ``keys`` makes it one pass over many series.
    """
    keys = list(keys)
    w = ensure_daily(weekly.select(*keys, date_col, *value_cols, *[c for c in tie_breakers if isinstance(c, str)]),
                     keys, date_col, tie_breakers)
    win = Window.partitionBy(*keys).orderBy(date_col)
    upto = win.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = [F.last(c, ignorenulls=True).over(upto).alias(c) for c in value_cols]
    nxt = F.lead(date_col).over(win)
    stepped = w.select(*keys, F.col(date_col).alias("_d"), nxt.alias("_next"), *filled)
    last_day = F.coalesce(F.date_sub("_next", 1), F.col("_d"))
    return stepped.select(*keys, F.explode(F.sequence("_d", last_day)).alias(date_col), *value_cols)
