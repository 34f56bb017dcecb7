"""Notice intervals to a daily stress signal.

Two plans with the same result:

* :func:`stress_from_notices` (expand): one row per (notice, active day), then
  ``groupBy(keys, date)`` with a distinct count. Rows grow with interval
  length; good when notices are short.
* :func:`stress_from_notices_sweep` (sweep): cut each interval to what no earlier
  one of its notice id covers, emit +1 at its start and -1 the day after
  the end, pre-aggregate the deltas per (keys, date), take a running sum over
  event dates, and expand only the *active segments*. Work is O(notices +
  output days), independent of interval length, and the ordered window sees
  one row per event date per key, never raw rows.

Both fill a missing effective time with the posted time and a missing end with
the effective time; an end before the start gives no days; notices with no
usable start are left out (:func:`unusable_notices` lists them, §8 Q14).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stresscast.functions.scalar import date_range

OUT_COLS = ("notice_active_count", "critical_active", "stress_event")


def _prepared(notices: DataFrame, keys: Sequence[str], id_col: str, critical_col: str | None) -> DataFrame:
    eff = F.coalesce(F.col("effective_dt"), F.col("posted_dt"))
    end = F.coalesce(F.col("end_dt"), eff)
    crit = F.coalesce(F.col(critical_col).cast("boolean"), F.lit(False)) if critical_col else F.lit(False)
    return notices.select(*keys, F.col(id_col).alias("_id"), crit.alias("_crit"),
                          F.to_date(eff).alias("_s"), F.to_date(end).alias("_e")).where(F.col("_s").isNotNull())


def unusable_notices(notices: DataFrame) -> DataFrame:
    """Notices with neither an effective nor a posted time (quarantine)."""
    return notices.where(F.coalesce("effective_dt", "posted_dt").isNull())


def _finish(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, "date",
                     F.col("notice_active_count").cast("bigint").alias("notice_active_count"),
                     F.col("critical_active").cast("int").alias("critical_active"),
                     F.col("critical_active").cast("int").alias("stress_event"))


def stress_from_notices(notices: DataFrame, keys: Sequence[str] = ("pipeline",), id_col: str = "notice_id",
                        critical_col: str | None = "critical") -> DataFrame:
    """A3 (expand plan): per (keys, date) distinct active notices and any-critical flag."""
    keys = list(keys)
    n = _prepared(notices, keys, id_col, critical_col)
    days = n.select(*keys, "_id", "_crit", F.explode(date_range("_s", "_e")).alias("date"))
    out = days.groupBy(*keys, "date").agg(
        F.count_distinct("_id").alias("notice_active_count"),
        F.max(F.col("_crit").cast("int")).alias("critical_active"))
    return _finish(out, keys)


def _first_covered(n: DataFrame, keys: Sequence[str], ends: Sequence[str]) -> DataFrame:
    """Per id and start day, and for each column of ``ends``: the first day (``<end>_from``) of [_s, end] that no
    earlier interval of the id covers, NULL when there is none. The parts are disjoint and together cover the same days.

    Copies of one id are first reduced to the latest ends per start day (a
    partial aggregation, so a notice re-posted millions of times is combined on
    the mappers); the ordered window then sees at most one row per start day
    of each id.
    """
    n = n.groupBy(*keys, "_id", "_s").agg(*[F.max(e).alias(e) for e in ends])
    before = Window.partitionBy(*keys, "_id").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    n = n.select("*", *[F.max(e).over(before).alias(f"{e}_before") for e in ends])
    return n.select(*keys, "_id", *ends, *[
        F.when(F.col(e).isNotNull() & (F.col(f"{e}_before").isNull() | (F.col(e) > F.col(f"{e}_before"))),
               F.greatest("_s", F.date_add(f"{e}_before", 1))).alias(f"{e}_from") for e in ends])


def stress_from_notices_sweep(notices: DataFrame, keys: Sequence[str] = ("pipeline",), id_col: str = "notice_id",
                              critical_col: str | None = "critical") -> DataFrame:
    """A3 (sweep plan): same result as :func:`stress_from_notices`, O(n) rows.

    One pass over the notices, one row per (keys, id, start day) with its latest end
    and its latest critical end; what no earlier interval of the id covers emits a
    +1/-1 pair, once for all and once for the critical ones, through one explode. A
    NULL-id notice adds a day and its critical flag but no count, as a distinct
    count ignores NULLs.
    """
    keys = list(keys)
    n = _prepared(notices, keys, id_col, critical_col).where(F.col("_e") >= F.col("_s"))
    parts = _first_covered(n.withColumn("_c", F.when(F.col("_crit"), F.col("_e"))), keys, ["_e", "_c"])
    pair = lambda end, kind: [F.when(F.col(f"{end}_from").isNotNull(), F.struct(
        day.alias("date"), F.lit(d).alias("d"), F.lit(kind).alias("kind")))
        for day, d in ((F.col(f"{end}_from"), 1), (F.date_add(end, 1), -1))]
    events = F.filter(F.array(*pair("_e", 0), *pair("_c", 1)), lambda e: e.isNotNull())
    ev = parts.select(*keys, F.col("_id").isNotNull().alias("_named"), F.explode(events).alias("_ev"))
    ev = (ev.select(*keys, F.col("_ev.date").alias("date"),
                    F.when(F.col("_named") & (F.col("_ev.kind") == 0), F.col("_ev.d")).otherwise(0).alias("_da"),
                    F.when(F.col("_ev.kind") == 1, F.col("_ev.d")).otherwise(0).alias("_dc"),
                    F.when(F.col("_ev.kind") == 0, F.col("_ev.d")).otherwise(0).alias("_dv"))
          .groupBy(*keys, "date").agg(F.sum("_da").alias("_da"), F.sum("_dc").alias("_dc"),
                                      F.sum("_dv").alias("_dv")))
    w = Window.partitionBy(*keys).orderBy("date")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seg = ev.select(*keys, F.col("date").alias("_from"),
                    F.sum("_da").over(run).alias("notice_active_count"),
                    F.sum("_dc").over(run).alias("_crit_n"),
                    F.sum("_dv").over(run).alias("_cover"),
                    F.lead("date").over(w).alias("_to"))
    seg = seg.where(F.col("_cover") > 0)
    out = seg.select(*keys, F.explode(F.sequence("_from", F.date_sub("_to", 1))).alias("date"),
                     "notice_active_count", (F.col("_crit_n") > 0).cast("int").alias("critical_active"))
    return _finish(out, keys)
