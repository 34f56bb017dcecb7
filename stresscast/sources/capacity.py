"""Capacity postings (S10, K9): landed CSV downloads to bronze rows.

Each landed download is a file plus its response headers. Files that are not
CSV (by content type or disposition) become error rows instead of data rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresscast.functions.scalar import format_utc
from stresscast.sources.shapes import read_by_header

# The 21 posting columns in source order; the unique key.
CAPACITY_COLS = ("Cycle_Desc", "Post_Date", "Eff_Gas_Day", "Cap_Type_Desc", "Post_Time", "Eff_Time", "Loc",
                 "Loc_Name", "Loc_Zn", "Flow_Ind_Desc", "Loc_Purp_Desc", "Loc_QTI_Desc", "Meas_Basis_Desc", "IT",
                 "All_Qty_Avail", "Total_Design_Capacity", "Operating_Capacity", "Total_Scheduled_Quantity",
                 "Operationally_Available_Capacity", "TSP_Name", "TSP")
CAPACITY_KEY = ("Loc_Name", "Post_Date", "TSP")


def is_csv_response(content_type, disposition):
    """K9 predicate: 'text/csv' in the content type or 'attachment' in the disposition."""
    ct = F.lower(F.coalesce(content_type, F.lit("")))
    disp = F.lower(F.coalesce(disposition, F.lit("")))
    return ct.contains("text/csv") | disp.contains("attachment")


def _is_header(line: Column) -> Column:
    """A line that names a key column of the postings."""
    return line.contains(CAPACITY_KEY[0]) & line.contains(CAPACITY_KEY[1])


def read_capacity_csv(spark: SparkSession, paths: str | Sequence[str], downloaded_at=None,
                      encoding: str = "UTF-8", line_breaks: bool = False) -> DataFrame:
    """Header row gives the fields; every string is stripped; source_url and
    downloaded_at_utc are added. Unknown extra columns are kept (§8 Q18).

    Each file is read by its own header (``sources/shapes.py``). Bytes that are no characters become U+FFFD (F34). A row that
    is too short or too long is kept with the cells it has and its line in ``_corrupt_record``.
    """
    df = read_by_header(spark, paths, _is_header, encoding=encoding, line_breaks=line_breaks)
    now = F.current_timestamp() if downloaded_at is None else F.lit(downloaded_at).cast("timestamp")
    return df.withColumnRenamed("file", "source_url").withColumn("downloaded_at_utc", format_utc(now))


def split_downloads(downloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K9: (csv downloads, error rows with error/content_type/disposition/url)."""
    ok = is_csv_response(F.col("content_type"), F.col("disposition"))
    good = downloads.where(ok)
    bad = downloads.where(~ok).select(F.lit("not_csv").alias("error"), F.lower("content_type").alias("content_type"),
                                      F.col("disposition"), F.col("url"))
    return good, bad
