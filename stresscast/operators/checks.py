"""Row checks in the pass that makes the rows.

Minimum row numbers and required values are counted by ``DataFrame.observe`` while another action writes the table, so a
check costs no job of its own. It is known once the action has ended; the table is then read or thrown away.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stresscast.session import staged


class FailedCheck(ValueError):
    """Rows that do not meet their checks; ``found`` holds the counts."""

    def __init__(self, message: str, found: Mapping[str, int]) -> None:
        super().__init__(message)
        self.found = dict(found)


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "rows") -> DataFrame:
    """The frame itself; raises if it lacks columns."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise FailedCheck(f"{what}: no column {', '.join(missing)}", {c: 0 for c in missing})
    return df


def checked(df: DataFrame, what: str, min_rows: int = 1, columns: Sequence[str] = (),
            at_least: Mapping[str, tuple[Column, int]] | None = None, name: str = "checked") -> DataFrame:
    """The rows, written once in the shared folder and counted on the way; raises :class:`FailedCheck` otherwise.

    ``min_rows`` rows at least, every one of ``columns`` present, and for each entry of ``at_least`` (name -> condition, number) as
    many rows that meet the condition. The counts are taken in the writing tasks, whose repetitions after a loss are not
    counted again.
    """
    require_columns(df, columns, what)
    wanted = {"rows": min_rows} | {k: n for k, (_, n) in (at_least or {}).items()}
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, (c, _) in (at_least or {}).items()]]
    table = staged(df.observe(seen, *counts), name)
    found = seen.get
    short = [f"{found[k]} {k} of at least {n}" for k, n in wanted.items() if found[k] < n]
    if short:
        raise FailedCheck(f"{what}: {', '.join(short)}", found)
    return table
