"""Sinks: stored documents (K3-K6), CSV output (K1), run manifest (K2).

Documents are built with ``select(struct(...))`` instead of per-row loops: the
station metadata is a left lookup join (J7; unknown stations get an empty
struct, one whose fields are all NULL), provenance is a constant struct, NaN never
appears (NULL-only). They are merged into a stored table by their key, nested
fields included (:func:`upsert_documents`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stresscast.functions.scalar import format_utc
from stresscast.operators.merge import keyed_merge
from stresscast.operators.ranks import join_null_safe
from stresscast.sources.energy import DEFAULT_PRICE_SERIES, META_COLS

# Fixed provenance values of the stored documents.
WEATHER_SOURCE = {"provider": "NOAA", "dataset": "GHCND", "access_base": ""}
PRICE_SOURCE = {"provider": "EIA", "endpoint": "natural_gas.spot_prices"}
STORAGE_SOURCE = {"provider": "EIA", "endpoint": "natural_gas.storage"}
STATION_DAY_KEY = ("pipeline", "ghcnd_station_id", "date")
REGION_DAY_KEY = ("pipeline", "region_id", "date")
PRICE_KEY = ("series", "date")
STORAGE_KEY = ("series", "region", "date")


def _struct(d: dict):
    return F.struct(*[F.lit(v).alias(k) for k, v in d.items()])


def station_day_documents(station_day: DataFrame, meta: DataFrame, pipeline: str | None, now) -> DataFrame:
    """K3: one document per (pipeline, station, date) with station_meta, updated_at_utc, source.

    ``pipeline`` None keeps the ``pipeline`` column of the input (many pipelines at once).
    """
    d = station_day if pipeline is None else station_day.withColumn("pipeline", F.lit(pipeline))
    fields = ("pipeline", "ghcnd_station_id", "station_name", "state")
    m = meta.select(*[F.col(c).alias(f"_m_{c}") for c in fields])
    j = d.join(m, F.col("ghcnd_station_id") == F.col("_m_ghcnd_station_id"), "left")
    return j.select("pipeline", "ghcnd_station_id", F.col("date").cast("string").alias("date"),
                    "tavg_c", "tmin_c", "tmax_c", "hdd",
                    F.struct(*[F.col(f"_m_{c}").alias(c) for c in fields]).alias("station_meta"),
                    F.lit(now).cast("timestamp").alias("updated_at_utc"), _struct(WEATHER_SOURCE).alias("source"))


def region_day_documents(region_daily: DataFrame, now) -> DataFrame:
    """K4: one document per (pipeline, region, date)."""
    return region_daily.select(
        "pipeline", "region_id", F.col("date").cast("string").alias("date"),
        F.col("n_stations_used").cast("bigint").alias("n_stations_used"),
        "tavg_c_median", "tavg_f_median", "hdd_median", "tavg_c_mean", "tavg_f_mean", "hdd_mean",
        F.lit(now).cast("timestamp").alias("updated_at_utc"), _struct(WEATHER_SOURCE).alias("source"))


def price_documents(prices: DataFrame, now) -> DataFrame:
    """K5: key (series, date); an absent, NULL or empty series takes the default id; value = the price."""
    return prices.select(
        (F.coalesce(F.nullif(F.col("series"), F.lit("")), F.lit(DEFAULT_PRICE_SERIES)) if "series" in prices.columns
         else F.lit(DEFAULT_PRICE_SERIES)).alias("series"), F.col("date").cast("string").alias("date"),
        F.col("henry_hub_usd_per_mmbtu").alias("value"),
        *[c for c in META_COLS if c != "series" and c in prices.columns],
        F.lit(now).cast("timestamp").alias("updated_at_utc"), _struct(PRICE_SOURCE).alias("source"))


def storage_documents(storage: DataFrame, now) -> DataFrame:
    """K6: key (series, region, date) - the region is part of the key (§8 Q16). The series has no default here: a row
    without one has no key."""
    return storage.select(
        "series", F.col("date").cast("string").alias("date"), "region", F.col("working_gas_bcf").alias("value"),
        *[c for c in META_COLS if c != "series" and c in storage.columns],
        F.lit(now).cast("timestamp").alias("updated_at_utc"), _struct(STORAGE_SOURCE).alias("source"))


def upsert_documents(existing: DataFrame, documents: DataFrame, key: Sequence[str], now,
                     order: Sequence = ("updated_at_utc",), fields_col: str | None = None) -> DataFrame:
    """K3-K6: documents merged by key; a field that a document does not have, nested ones included, keeps its stored value.

    Of several documents of a key the one latest by ``order`` wins (columns that stay in the document). The result has
    ``_action`` per key (see :func:`keyed_merge`).
    """
    return keyed_merge(existing, documents, list(key), now, [F.col(c) if isinstance(c, str) else c for c in order], fields_col)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K1: CSV with a header; one folder, one file per partition (no single-file funnel)."""
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def row_checksum(columns: Sequence[str]):
    """Sum over rows of the first 32 bits of a row's MD5: the same for any order and number of files."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return F.coalesce(F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")), F.lit(0)).cast("bigint")


#: Fields of a station's record in the manifest.
STATION_FIELDS = ("pipeline", "region_id", "ghcnd_station_id", "station_name", "state")


def write_run_manifest(stations: DataFrame, path: str, *, now, outputs: dict, date_filter: dict, aggregation: dict) -> None:
    """K2: the manifest of a run over any number of pipelines, as a folder.

    ``stations/``: the records of the stations that were used, once each, in as many JSON files as the data need, one folder a
    pipeline. ``header/``: one record per pipeline and region with the time, the number of its stations and their checksum, the
    source, the outputs, the date filter and notes on the aggregation. The header is written last, from the files that
    were written: a manifest with a header is complete.
    """
    spark = stations.sparkSession
    records = stations.groupBy("ghcnd_station_id", "pipeline", "region_id").agg(
        *[F.min(c).alias(c) for c in STATION_FIELDS if c not in ("ghcnd_station_id", "pipeline", "region_id")])
    records.select(*STATION_FIELDS, F.col("pipeline").alias("of")).write.partitionBy("of").json(f"{path}/stations")
    header = _read_stations(spark, path).groupBy("pipeline", "region_id").agg(
        F.count(F.lit(1)).alias("stations_count"), row_checksum(STATION_FIELDS).alias("stations_checksum")).select(
        "pipeline", "region_id", format_utc(F.lit(now).cast("timestamp")).alias("generated_at_utc"), "stations_count",
        "stations_checksum", _struct(WEATHER_SOURCE).alias("source"), _struct(outputs).alias("outputs"),
        _struct({k: v or "" for k, v in date_filter.items()}).alias("date_filter"), _struct(aggregation).alias("aggregation"))
    header.coalesce(1).write.json(f"{path}/header")


def _read_stations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).schema(", ".join(f"{c} string" for c in STATION_FIELDS)).json(f"{path}/stations")


def read_run_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """K2: header and station records of a written manifest; raises if files are missing, doubled or changed."""
    header, stations = spark.read.json(f"{path}/header"), _read_stations(spark, path)
    found = stations.groupBy("pipeline", "region_id").agg(F.count(F.lit(1)).alias("_n"), row_checksum(STATION_FIELDS).alias("_sum"))
    claimed = header.select("pipeline", "region_id", "stations_count", "stations_checksum")
    wrong = join_null_safe(claimed.unionByName(found.select("pipeline", "region_id", F.lit(None).alias("stations_count"),
                                                            F.lit(None).alias("stations_checksum"))).groupBy("pipeline", "region_id")
                           .agg(F.max("stations_count").alias("n"), F.max("stations_checksum").alias("sum")), found,
                           ["pipeline", "region_id"], "left").where(
        ~F.col("n").eqNullSafe(F.col("_n")) | ~F.col("sum").eqNullSafe(F.col("_sum"))).limit(1).collect()
    if wrong:
        raise ValueError(f"the manifest of {wrong[0]['pipeline']} lists {wrong[0]['n']} stations, its files hold {wrong[0]['_n']}")
    return header, stations
