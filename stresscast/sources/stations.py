"""Weather station sources: raw station files (S7), station map.

Station files differ in their columns (some lack TAVG), so they are read by
header (``sources/shapes.py``): one reader call per distinct header, every row
keeps its file's name for the station id. No file is opened on the driver and
no row is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from stresscast.functions.scalar import (
    hdd_from_tavg_c, strip_ws, tenths, to_date_lenient,
)
from stresscast.operators.dedupe import keep_first
from stresscast.sources.shapes import read_by_header
from stresscast.sources.tables import date_between

MEASURES = ("TAVG", "TMIN", "TMAX")
#: The station id in a file's path: its name without ``.csv``.
STATION_IN_PATH = r"([^/]+?)(\.csv)?$"


def _is_header(line: Column) -> Column:
    """A line with the cell DATE (most lines are told by not having the letters)."""
    return line.contains("DATE") & F.array_contains(F.transform(F.split(line, ","), lambda s: F.regexp_replace(strip_ws(s), r'^\uFEFF?"|"$|^\uFEFF', "")),
                            "DATE")


def read_station_files(spark: SparkSession, paths: str | Sequence[str], station: str = STATION_IN_PATH) -> DataFrame:
    """Raw rows of many station CSV files: ghcnd_station_id, DATE, TAVG, TMIN, TMAX.

    ``station``: pattern whose first group is the station id in the file's path. Files whose header has
    no DATE column yield no rows (see :func:`station_files_without_date`).
    """
    rows = read_by_header(spark, paths, _is_header, ("DATE", *MEASURES))
    return rows.select(F.regexp_extract("file", station, 1).alias("ghcnd_station_id"), "DATE", *MEASURES)


def station_files_without_date(spark: SparkSession, paths) -> DataFrame:
    """Files that cannot be read as station files (P17: DATE is required)."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths if isinstance(paths, str) else list(paths))
    return (lines.groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.max(_is_header(F.col("value")).cast("int")).alias("has_date"))
            .where("has_date = 0").select("file"))


def normalize_station_rows(raw: DataFrame, start=None, end=None) -> DataFrame:
    """S7 + F3 + P15 + F2: typed station-day rows.

    Input columns: ghcnd_station_id, DATE, and any of TAVG/TMIN/TMAX in tenths
    of a degree C (strings or numbers; absent columns count as NULL). Bad dates
    are dropped; values that are not numbers become NULL; TAVG falls back to
    the mean of TMIN and TMAX when both are present.
    """
    d = raw
    for c in MEASURES:
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("string"))
    is_date = isinstance(d.schema["DATE"].dataType, DateType)
    d = d.select(
        F.col("ghcnd_station_id"),
        (F.col("DATE") if is_date else to_date_lenient("DATE")).alias("date"),
        tenths("TAVG").alias("tavg_c"),
        tenths("TMIN").alias("tmin_c"),
        tenths("TMAX").alias("tmax_c"),
        *[c for c in d.columns if c not in ("ghcnd_station_id", "DATE") + MEASURES],
    ).where(F.col("date").isNotNull() & date_between("date", start, end))
    d = d.withColumn("tavg_c", F.coalesce("tavg_c", (F.col("tmin_c") + F.col("tmax_c")) / 2.0))
    return d.withColumn("hdd", hdd_from_tavg_c("tavg_c"))


def read_station_map(spark: SparkSession, path: str) -> DataFrame:
    """Station map CSV with a file-order column ``_pos`` for keep-first dedupe."""
    df = spark.read.option("header", True).csv(path)
    return df.withColumn("_pos", F.monotonically_increasing_id())


def load_station_meta(stations: DataFrame, pipeline: str | None,
                      order_col: str = "_pos", require_nonempty: bool = False) -> DataFrame:
    """Required columns, strip/lower, pipeline filter, optional columns, keep first per station.

    ``pipeline=None`` keeps every pipeline (the vectorized form).
    """
    missing = {"pipeline", "ghcnd_station_id"} - set(stations.columns)
    if missing:
        raise ValueError(f"the station map needs the columns {sorted(missing)}")
    d = stations
    for c in ("station_name", "state"):
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("string"))
    d = d.select(
        F.lower(strip_ws(F.col("pipeline").cast("string"))).alias("pipeline"),
        strip_ws(F.col("ghcnd_station_id").cast("string")).alias("ghcnd_station_id"),
        F.col("station_name").cast("string").alias("station_name"),
        F.col("state").cast("string").alias("state"),
        F.col(order_col).alias("_pos"),
    )
    if pipeline is not None:
        d = d.where(F.col("pipeline") == pipeline.strip().lower())
    d = keep_first(d, ["pipeline", "ghcnd_station_id"], ["_pos"])
    if require_nonempty and d.limit(1).count() == 0:
        raise ValueError(f"the station map has no station of pipeline {pipeline!r}")
    return d.drop("_pos")
