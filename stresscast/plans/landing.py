"""Queries over landed files, run manifests and checked tables, with their SQL.

Files are written from the driver tables into the shared folder and read back by the library's readers, so every query
covers whole tables and the reader's way from bytes to rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stresscast.operators.checks import checked
from stresscast.operators.merge import flattened
from stresscast.plans.catalogue import (BACKTEST_END, MERGE_NOW, _station_meta_table, energy_rows, model_frame, region_daily,
                                        round_doubles, station_day, storage_daily, stress_daily, capacity_median)
from stresscast.plans.oracle import _AUC, _SCORED_DESCRIBE, MF_DOUBLES
from stresscast.plans.oracle import ORACLE as BASE_ORACLE
from stresscast.plans.oracle import sql_with
from stresscast.session import scratch_path
from stresscast.sources import driver_views as V
from stresscast.sources.tables import read_table

QUERIES, ORACLE = {}, {}


# ------------------------------------------------------ files by header
def _raw_lines(lines, header: str, path: str) -> None:
    """Lines as they are, in Latin-1, under a header line in every file."""
    (lines.select(F.col("line").alias(header)).write.option("header", True).option("encoding", "ISO-8859-1")
     .option("sep", "\x01").option("quote", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def q_landed_capacity_rows(spark, base):
    """Capacity postings in two kinds of files: quoted cells, short and long rows, bytes that are no UTF-8."""
    from stresscast.sources.capacity import read_capacity_csv
    geo = V.supplier_geo(spark, base)
    li = read_table(spark, base, "lineitem").join(geo, F.col("l_suppkey") == geo.s_suppkey)
    n = F.col("l_linenumber")
    loc = F.concat(F.lit("LOC"), F.col("l_partkey").cast("string"), F.when(n == 2, F.lit("é")).otherwise(F.lit("")))
    tsp = F.when(n == 3, F.concat(F.lit('"'), F.upper("pipeline"), F.lit(', ""EAST"""'))).otherwise(F.upper("pipeline"))
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    qty = F.concat(F.lit("  "), F.col("l_quantity").cast("bigint").cast("string"), F.lit(" "))
    odd = F.col("l_orderkey") % 2 == 1
    root = scratch_path(spark, "capacity")
    full = F.concat_ws(",", loc, day, qty, tsp)
    line = F.when(n == 4, F.concat_ws(",", loc, day)).when(n == 5, F.concat(full, F.lit(",more"))).otherwise(full)
    _raw_lines(li.where(~odd).select(line.alias("line")), "Loc_Name,Post_Date,All_Qty_Avail,TSP", f"{root}/a")
    line = F.concat_ws(",", tsp, loc, day, qty, F.lit("Timely"))
    _raw_lines(li.where(odd).select(line.alias("line")), "TSP,Loc_Name,Post_Date,All_Qty_Avail,Cycle_Desc", f"{root}/b")
    rows = read_capacity_csv(spark, [f"{root}/a", f"{root}/b"], MERGE_NOW)
    return rows.select("Loc_Name", "Post_Date", "All_Qty_Avail", "TSP", "Cycle_Desc",
                       F.col("_corrupt_record").isNotNull().alias("damaged"), "downloaded_at_utc")


ORACLE["landed_capacity_rows"] = sql_with("""
    SELECT 'LOC' || l_partkey || CASE WHEN l_linenumber = 2 THEN chr(65533) ELSE '' END AS Loc_Name,
           strftime(l_shipdate, '%Y-%m-%d') AS Post_Date,
           CASE WHEN l_linenumber = 4 AND l_orderkey % 2 = 0 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS All_Qty_Avail,
           CASE WHEN l_linenumber = 4 AND l_orderkey % 2 = 0 THEN NULL WHEN l_linenumber = 3 THEN upper(pipeline) || ', "EAST"'
                ELSE upper(pipeline) END AS TSP,
           CASE WHEN l_orderkey % 2 = 1 THEN 'Timely' END AS Cycle_Desc,
           l_linenumber IN (4, 5) AND l_orderkey % 2 = 0 AS damaged, '2001-01-01T00:00:00Z' AS downloaded_at_utc
    FROM lineitem JOIN supplier_geo ON l_suppkey = s_suppkey""", "supplier_geo")


def q_landed_station_days(spark, base):
    """Station files with and without TAVG, one folder a station, normalized."""
    from stresscast.sources.stations import normalize_station_rows, read_station_files
    raw = V.station_raw(spark, base).withColumn("station", F.col("ghcnd_station_id"))
    root = scratch_path(spark, "stations")
    for name, rows in (("full", raw.where("l_suppkey % 2 = 0").select("station", "DATE", "TAVG", "TMIN", "TMAX")),
                       ("short", raw.where("l_suppkey % 2 = 1").select("station", "TMAX", "TMIN", "DATE"))):
        rows.repartition("station").write.partitionBy("station").option("header", True).csv(f"{root}/{name}")
    rows = read_station_files(spark, [f"{root}/full", f"{root}/short"], station="station=([^/]+)/")
    return round_doubles(normalize_station_rows(rows))


ORACLE["landed_station_days"] = sql_with("""
    SELECT ghcnd_station_id, date, tavg_c, tmin_c, tmax_c,
           CASE WHEN tavg_c IS NOT NULL THEN greatest(0.0, 65.0 - (tavg_c * 9.0 / 5.0 + 32.0)) END AS hdd
    FROM (SELECT ghcnd_station_id, "DATE" AS date, TMIN / 10.0 AS tmin_c, TMAX / 10.0 AS tmax_c,
                 coalesce(CASE WHEN l_suppkey % 2 = 0 THEN TAVG / 10.0 END, (TMIN / 10.0 + TMAX / 10.0) / 2.0) AS tavg_c
          FROM station_raw)""", "station_raw", round_cols=("tavg_c", "tmin_c", "tmax_c", "hdd"))


def q_landed_downloads(spark, base):
    """K9: downloads that are not CSV by content type and disposition, one per order."""
    from stresscast.sources.capacity import split_downloads
    k = F.col("o_orderkey")
    o = read_table(spark, base, "orders").select(
        F.concat(F.lit("http://ebb.example/"), k.cast("string")).alias("url"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 3 == 0, F.lit("Text/CSV; charset=utf-8")).otherwise(F.lit("text/HTML")).alias("content_type"),
        F.when(k % 7 == 0, F.lit("Attachment; filename=a.csv")).when(k % 2 == 0, F.lit("inline")).alias("disposition"))
    return split_downloads(o)[1]


ORACLE["landed_downloads"] = """
    SELECT 'not_csv' AS error, lower(content_type) AS content_type, disposition, url FROM (
        SELECT 'http://ebb.example/' || o_orderkey AS url,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'Text/CSV; charset=utf-8' ELSE 'text/HTML' END AS content_type,
               CASE WHEN o_orderkey % 7 = 0 THEN 'Attachment; filename=a.csv' WHEN o_orderkey % 2 = 0 THEN 'inline' END AS disposition
        FROM orders)
    WHERE NOT (lower(coalesce(content_type, '')) LIKE '%text/csv%' OR lower(coalesce(disposition, '')) LIKE '%attachment%')"""


# ------------------------------------------------------ checks in the same pass
def q_checked_prices(spark, base):
    """Price rows, written once and counted on the way: at least 100 rows and 100 known prices."""
    from stresscast.sources.energy import normalize_prices
    prices = normalize_prices(energy_rows(spark, base))
    return round_doubles(checked(prices, "prices", 100, ["date", "series", "henry_hub_usd_per_mmbtu"],
                                 {"known prices": (F.col("henry_hub_usd_per_mmbtu").isNotNull(), 100)}))


ORACLE["checked_prices"] = BASE_ORACLE["normalize_prices"]


# ------------------------------------------------------ run manifest (K2)
def _manifest(spark, base):
    from stresscast.sources.sinks import read_run_manifest, write_run_manifest
    used = station_day(spark, base).join(_station_meta_table(spark, base), "ghcnd_station_id")
    path = scratch_path(spark, "manifest")
    write_run_manifest(used, path, now=MERGE_NOW, date_filter={"start_date": None, "end_date": "2001-12-31"},
                       outputs={"station_csv": "station_day", "region_csv": "region_daily"},
                       aggregation={"tavg": "median and mean of the stations", "hdd": "of the stations, base 65F"})
    return read_run_manifest(spark, path)


def q_run_manifest(spark, base):
    """K2: one header per pipeline, its station count and checksum verified against the station files."""
    return flattened(_manifest(spark, base)[0])


def q_run_manifest_stations(spark, base):
    """K2: the full station records of the manifest."""
    return _manifest(spark, base)[1]


_STATIONS = """
    SELECT p.pipeline, p.region_id, p.ghcnd_station_id, s.s_name AS station_name, n.n_name AS state
    FROM station_pipeline p JOIN supplier s ON p.ghcnd_station_id = 'ST' || s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
    WHERE p.ghcnd_station_id IN (SELECT ghcnd_station_id FROM station_raw)"""
ORACLE["run_manifest_stations"] = sql_with(_STATIONS, "station_pipeline", "station_raw")
ORACLE["run_manifest"] = sql_with(f"""
    SELECT pipeline, region_id, '2001-01-01T00:00:00Z' AS generated_at_utc, count(*) AS stations_count,
           CAST(sum(('0x' || substr(md5(concat_ws('|', pipeline, region_id, ghcnd_station_id, station_name, state)), 1, 8))::BIGINT)
                AS BIGINT) AS stations_checksum,
           'NOAA' AS source_provider, 'GHCND' AS source_dataset, '' AS source_access_base, 'station_day' AS outputs_station_csv,
           'region_daily' AS outputs_region_csv, '' AS date_filter_start_date, '2001-12-31' AS date_filter_end_date,
           'median and mean of the stations' AS aggregation_tavg, 'of the stations, base 65F' AS aggregation_hdd
    FROM ({_STATIONS}) GROUP BY pipeline, region_id""", "station_pipeline", "station_raw")


# ------------------------------------------------------ frame with provenance (M1), discrimination (E3), stress back-test
def q_model_frame_source(spark, base):
    """M1: the frame built from stored region documents keeps their provenance."""
    from stresscast.plans.frame import FrameConfig, build_model_frame
    from stresscast.sources.sinks import region_day_documents
    weather = region_day_documents(region_daily(spark, base), MERGE_NOW).withColumn("date", F.col("date").cast("date"))
    frame = build_model_frame(weather, V.price_daily(spark, base), storage_daily(spark, base), stress_daily(spark, base),
                              capacity_median(spark, base), FrameConfig(dedupe=False))
    return round_doubles(flattened(frame))


ORACLE["model_frame_source"] = sql_with("""
    SELECT *, 'NOAA' AS source_provider, 'GHCND' AS source_dataset, '' AS source_access_base FROM model_frame_v""",
                                        "model_frame_v", round_cols=MF_DOUBLES)


def q_event_discrimination(spark, base):
    """Scores joined to realized outcomes (every eleventh is not known yet), described per outcome, with the AUC."""
    from stresscast.plans.evaluate import discrimination
    scored = V.scored(spark, base)
    outcomes = scored.select("event_id", F.when(F.col("event_id") % 11 != 0, F.col("outcome")).alias("outcome"))
    return round_doubles(discrimination(scored.drop("outcome"), outcomes, "score", "outcome", on=["event_id"]))


_KNOWN = "(SELECT score, outcome FROM scored WHERE event_id % 11 <> 0) AS scored"
ORACLE["event_discrimination"] = sql_with(
    "SELECT * FROM (" + _SCORED_DESCRIBE.format(keys="outcome,", group="GROUP BY outcome").replace("FROM scored", f"FROM {_KNOWN}")
    + ") AS d, (" + _AUC.format(score="score", label="outcome", src=_KNOWN) + ") AS a", "scored",
    round_cols=("mean", "std", "min", "p25", "p50", "p75", "max", "auc"))


def q_backtest_days_stress_source(spark, base):
    """E1 with inputs from the test rows only, as the source computes them."""
    from stresscast.plans.backtest import stress_backtest
    _, scored = stress_backtest(model_frame(spark, base), BACKTEST_END, inputs="test_rows")
    return scored.select("pipeline", "date", "stress_event", F.col("p_stress").isNotNull().alias("scored"))


ORACLE["backtest_days_stress_source"] = sql_with("""
    SELECT pipeline, date, stress_event, lag(hdd_median) OVER w IS NOT NULL AND lag(working_gas_bcf) OVER w IS NOT NULL
           AND lag(all_qty_avail_median) OVER w IS NOT NULL AND lag(notice_active_count) OVER w IS NOT NULL AS scored
    FROM model_frame_v WHERE date > DATE '1998-06-30' WINDOW w AS (PARTITION BY pipeline ORDER BY date)""", "model_frame_v")

QUERIES.update({
    "landed_capacity_rows": q_landed_capacity_rows,
    "landed_station_days": q_landed_station_days,
    "landed_downloads": q_landed_downloads,
    "checked_prices": q_checked_prices,
    "run_manifest": q_run_manifest,
    "run_manifest_stations": q_run_manifest_stations,
    "model_frame_source": q_model_frame_source,
    "event_discrimination": q_event_discrimination,
    "backtest_days_stress_source": q_backtest_days_stress_source,
})
