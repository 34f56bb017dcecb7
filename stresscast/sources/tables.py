"""Table scans (S1-S6) over parquet tables.

Every loader returns a lazy DataFrame; Catalyst pushes the range/equality
filters into the parquet scan (``PushedFilters``) and prunes columns
(``ReadSchema``). Dates are compared as DATE values, never as strings (§8 Q5).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from stresscast.functions.scalar import parse_utc_strict, to_date_lenient, to_ts_lenient


def as_date(df: DataFrame, col: str):
    """The column as DATE: kept when it already is one (so filters on it still reach the scan
    or pass below an aggregate on it), day of a timestamp, lenient parse of text."""
    t = df.schema[col].dataType
    if isinstance(t, DateType):
        return F.col(col)
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.to_date(col)
    return to_date_lenient(col)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def date_between(col, start=None, end=None):
    """P5: closed date range, each bound optional. Returns a Column predicate."""
    c = F.col(col) if isinstance(col, str) else col
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (c <= F.lit(end).cast("date"))
    return cond


def scan(df: DataFrame, *, where=None, columns: Sequence[str] | None = None,
         sort: Sequence | None = None, limit: int | None = None,
         date_col: str | None = None, parse_dates: bool = True) -> DataFrame:
    """Generic scan - filter, projection, sort, limit, lenient date parse.

    A falsy ``limit`` means no limit. With a sort and a limit Spark plans a
    TakeOrderedAndProject (per-partition top-k, then merge), not a full sort.
    An empty result keeps its schema.
    """
    out = df
    if where is not None:
        out = out.where(where)
    if parse_dates and date_col and date_col in out.columns:
        out = out.withColumn(date_col, as_date(out, date_col))
    if columns:
        out = out.select(*columns)
    if sort:
        out = out.orderBy(*[F.col(s).asc_nulls_last() if isinstance(s, str) else s for s in sort])
    if limit:
        out = out.limit(int(limit))
    return out


def load_price_daily(df: DataFrame, start=None, end=None) -> DataFrame:
    """Daily price in a closed range; ``value`` renamed to the model name."""
    d = df.withColumn("date", as_date(df, "date"))
    if "value" in d.columns:
        d = d.withColumnRenamed("value", "henry_hub_usd_per_mmbtu")
    return d.where(date_between("date", start, end)).select(
        "date", "henry_hub_usd_per_mmbtu", "units", "series")


def load_storage_weekly(df: DataFrame, start=None, end=None, region: str | None = None) -> DataFrame:
    """S3: weekly storage in a range with optional region equality."""
    d = df.withColumn("date", as_date(df, "date"))
    if "value" in d.columns:
        d = d.withColumnRenamed("value", "working_gas_bcf")
    cond = date_between("date", start, end)
    if region is not None:
        cond = cond & (F.col("region") == region)
    return d.where(cond).select("date", "region", "working_gas_bcf", "units", "series")


def load_region_daily(df: DataFrame, pipeline: str | None = None, start=None, end=None,
                      region_id: str | None = None) -> DataFrame:
    """Pipeline equality (None = all pipelines) + optional range + optional region."""
    d = df.withColumn("date", as_date(df, "date"))
    cond = date_between("date", start, end)
    if pipeline is not None:
        cond = cond & (F.col("pipeline") == pipeline)
    if region_id is not None:
        cond = cond & (F.col("region_id") == region_id)
    return d.where(cond)


def load_capacity(df: DataFrame, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Capacity postings; parse ``Post_Date`` first, then range (fixes §8 Q5)."""
    d = (df.withColumn("Post_Date_dt", to_date_lenient("Post_Date"))
           .withColumn("Eff_Gas_Day_dt", to_date_lenient("Eff_Gas_Day") if "Eff_Gas_Day" in df.columns
                       else F.lit(None).cast("date")))
    if "downloaded_at_utc" in d.columns and isinstance(d.schema["downloaded_at_utc"].dataType, StringType):
        d = d.withColumn("downloaded_at_utc", to_ts_lenient("downloaded_at_utc"))
    d = d.where(date_between("Post_Date_dt", start, end))
    sort = ["Post_Date_dt"] + (["Post_Time"] if "Post_Time" in d.columns else [])
    return scan(d, sort=sort if limit else None, limit=limit, parse_dates=False)


def load_notices(df: DataFrame, start=None, end=None, only_active: bool = False,
                 as_of=None, limit: int | None = None) -> DataFrame:
    """``posted_dt`` in [start, end + 1 day); optional active-at-``as_of``.

    ``as_of`` is an argument (never ``now()``) so reruns are reproducible.
    """
    d = df
    for c in ("posted_dt", "effective_dt", "end_dt"):
        if c in d.columns and isinstance(d.schema[c].dataType, StringType):
            d = d.withColumn(c, to_ts_lenient(c))  # text at the edge; typed timestamps are kept as they are
    cond = F.lit(True)
    if start is not None:
        parse_utc_strict(start)  # a bad bound is an error, not an empty result
        cond = cond & (F.col("posted_dt") >= F.lit(start).cast("timestamp"))
    if end is not None:
        parse_utc_strict(end)
        # F8: the whole end day is included: posted < end + 1 day
        cond = cond & (F.col("posted_dt") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    if only_active:
        if as_of is None:
            raise ValueError("only_active needs an explicit as_of timestamp")
        cond = cond & active_at("end_dt", as_of)
    d = d.where(cond)
    return scan(d, sort=["posted_dt"] if limit else None, limit=limit, parse_dates=False)


def active_at(end_col, as_of):
    """Interval still open at an instant: end IS NULL OR end >= as_of."""
    e = F.col(end_col) if isinstance(end_col, str) else end_col
    return e.isNull() | (e >= F.lit(as_of).cast("timestamp"))
