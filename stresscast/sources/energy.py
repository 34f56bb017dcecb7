"""Energy-statistics rows (S9): price and storage API rows to typed tables.

Input rows are what the statistics API returns (``spark.read.json`` of the
landed responses): ``period``, ``value`` (text), ``units``, ``series``,
``series-description``, ``duoarea``, ``area-name``, ``product``,
``product-name``, ``process``, ``process-name``; any may be absent except
``period`` and ``value``. One ``select`` built from a column map does the
rename, typing and defaulting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresscast.functions.scalar import format_date, to_date_lenient, to_double

# Source column names and the default series ids.
RENAMES = {"period": "date", "series-description": "series_description", "area-name": "area_name",
           "process-name": "process_name", "product-name": "product_name"}
DEFAULT_PRICE_SERIES = "RNGWHHD"
DEFAULT_STORAGE_SERIES = "NW2_EPG0_SWO_R48_BCF"
META_COLS = ("units", "series", "series_description", "duoarea", "area_name", "product", "product_name", "process",
             "process_name")


def read_energy_rows(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses (JSON lines, one row object per line)."""
    return spark.read.json(path)


def _typed(rows: DataFrame, value_name: str, default_series: str, carry: Sequence[str] = (),
           fill_empty: bool = False) -> DataFrame:
    cols = {RENAMES.get(c, c): c for c in rows.columns}
    if "date" not in cols or "value" not in cols:
        raise ValueError(f"rows need a date and a value column, found {sorted(rows.columns)}")

    def src(name):
        return F.col(f"`{cols[name]}`").cast("string") if name in cols else F.lit(None).cast("string")

    d = rows.select(to_date_lenient(src("date")).alias("_d"), to_double(src("value")).alias(value_name),
                    *[src(c).alias(c) for c in META_COLS], *carry)
    d = d.where(F.col("_d").isNotNull())
    if "series" not in cols:
        return d.withColumn("series", F.lit(default_series))
    return d.withColumn("series", F.coalesce(F.nullif(F.col("series"), F.lit("")), F.lit(default_series))) if fill_empty else d


def normalize_prices(rows: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Daily price table: date (YYYY-MM-DD), henry_hub_usd_per_mmbtu, units, series, ... (fixed order).

    ``carry`` names columns to take along as they are (a sequence number for a later merge).

    A missing or empty series takes the default id (the write-side rule).
    """
    d = _typed(rows, "henry_hub_usd_per_mmbtu", DEFAULT_PRICE_SERIES, carry, fill_empty=True)
    return d.select(format_date("_d").alias("date"), "henry_hub_usd_per_mmbtu", *META_COLS, *carry)


def normalize_storage(rows: DataFrame, region: str | Column) -> DataFrame:
    """Weekly storage table with a region column (a constant, or an expression over the rows); keyed by (series, region,
    date) (§8 Q16). Rows without a series column take the default id; an empty series stays as it is."""
    at = region if isinstance(region, Column) else F.lit(region)
    d = _typed(rows.withColumn("_region", at), "working_gas_bcf", DEFAULT_STORAGE_SERIES, ["_region"])
    return d.select(format_date("_d").alias("date"), F.col("_region").alias("region"), "working_gas_bcf", *META_COLS)
