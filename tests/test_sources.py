import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from stresscast.operators.aggregates import aggregate_region_daily, capacity_daily_median
from stresscast.sources.capacity import read_capacity_csv, split_downloads
from stresscast.sources.energy import normalize_prices, normalize_storage, read_energy_rows
from stresscast.sources.stations import (load_station_meta, normalize_station_rows, read_station_files,
                                         read_station_map, station_files_without_date)
from tests.conftest import rows


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_station_files_by_header(spark, tmpdir_path):
    d = tmpdir_path
    write(f"{d}/USW1.csv", '"STATION","DATE","NAME","TAVG","TMAX","TMIN"\n'
          '"USW1","2024-01-01","BOSTON, MA US","50","100","0"\n'      # TAVG present
          '"USW1","2024-01-02","BOSTON, MA US","","100","20"\n'        # TAVG missing: mean of min/max
          '"USW1","2024-01-03","BOSTON, MA US","","100",""\n'          # one missing: NULL
          '"USW1","not-a-date","BOSTON, MA US","1","1","1"\n'          # bad date: dropped
          '"USW1","2024-01-05","BOSTON, MA US","abc","","" \n')        # non-numeric: NULL
    write(f"{d}/USW2.csv", '"STATION","DATE","TMAX","TMIN"\n"USW2","2024-01-01","-10","-30"\n')  # no TAVG column
    write(f"{d}/BAD.csv", '"STATION","DAY","TAVG"\n"BAD","2024-01-01","1"\n')                   # no DATE column
    raw = read_station_files(spark, d)
    st = rows(normalize_station_rows(raw), "ghcnd_station_id", "date")
    got = {(r["ghcnd_station_id"], r["date"].day): (r["tavg_c"], r["hdd"]) for r in st}
    assert got[("USW1", 1)][0] == 5.0
    assert got[("USW1", 2)][0] == 6.0
    assert got[("USW1", 3)] == (None, None)
    assert got[("USW1", 5)] == (None, None)
    assert got[("USW2", 1)][0] == -2.0 and got[("USW2", 1)][1] == pytest.approx(65 - (-2 * 1.8 + 32))
    assert len([k for k in got if k[0] == "USW1"]) == 4
    assert [r["file"].split("/")[-1] for r in station_files_without_date(spark, d).collect()] == ["BAD.csv"]
    agg = rows(aggregate_region_daily(normalize_station_rows(raw).withColumn("pipeline", F.lit("p"))
                                      .withColumn("region_id", F.lit("r"))), "date")
    assert agg[0]["n_stations_used"] == 2 and agg[0]["tavg_c_median"] == pytest.approx(1.5)
    assert agg[0]["tavg_f_median"] == pytest.approx(1.5 * 9 / 5 + 32)


def test_station_map(spark, tmpdir_path):
    p = write(f"{tmpdir_path}/map.csv", "airport,ghcnd_station_id,pipeline\nBOS, S1 ,  Algonquin \n"
              "BDL,S1,algonquin\nPVD,S2,ALGONQUIN\nX,S3,other\n")
    m = rows(load_station_meta(read_station_map(spark, p), "algonquin"), "ghcnd_station_id")
    assert [r["ghcnd_station_id"] for r in m] == ["S1", "S2"]
    assert m[0]["station_name"] is None and m[0]["state"] is None
    with pytest.raises(ValueError):
        load_station_meta(read_station_map(spark, p), "nothing", require_nonempty=True)
    with pytest.raises(ValueError):
        load_station_meta(read_station_map(spark, p).drop("pipeline"), "x")


def test_energy_rows(spark, tmpdir_path):
    recs = [{"period": "2024-01-02", "value": "2.5", "units": "$/MMBTU", "series": "RNGWHHD",
             "series-description": "HH"},
            {"period": "bad", "value": "1"},
            {"period": "2024-01-01", "value": "NA", "series": ""},
            {"period": "2024-01-03", "value": "-0.5"}]
    p = write(f"{tmpdir_path}/rows.json", "\n".join(json.dumps(r) for r in recs))
    out = rows(normalize_prices(read_energy_rows(spark, p)), "date")
    assert [r["date"] for r in out] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert out[0]["henry_hub_usd_per_mmbtu"] is None and out[0]["series"] == "RNGWHHD"
    assert out[1]["series_description"] == "HH" and out[1]["duoarea"] is None
    assert out[2]["henry_hub_usd_per_mmbtu"] == -0.5
    st = normalize_storage(read_energy_rows(spark, p), "lower48").first()
    assert st["region"] == "lower48" and st["series"] in ("RNGWHHD", "NW2_EPG0_SWO_R48_BCF")
    with pytest.raises(ValueError):
        normalize_prices(spark.createDataFrame([("x",)], "period string"))


def test_capacity_csv_and_median(spark, tmpdir_path):
    p = write(f"{tmpdir_path}/cap.csv", "Loc_Name,Post_Date,TSP,All_Qty_Avail,Extra\n"
              " A ,2024-01-01, 1 , 100 ,z\nB,2024-01-01,1,300,z\nC,2024-01-01,1,n/a,z\nD,bad,1,5,z\n"
              "E,2024-01-02,1,7,z\n")
    cap = read_capacity_csv(spark, p, downloaded_at="2024-01-03 00:00:00")
    first = rows(cap, "Loc_Name")[0]
    assert first["Loc_Name"] == "A" and first["All_Qty_Avail"] == "100" and first["Extra"] == "z"
    assert first["downloaded_at_utc"] == "2024-01-03T00:00:00Z"
    med = rows(capacity_daily_median(cap.withColumn("pipeline", F.lit("p"))), "date")
    assert [(r["date"].day, r["all_qty_avail_median"]) for r in med] == [(1, 200.0), (2, 7.0)]
    dl = spark.createDataFrame([("text/csv; charset=utf-8", "", "u1"), ("text/html", "inline", "u2"),
                                ("application/octet-stream", "attachment; f.csv", "u3")],
                               "content_type string, disposition string, url string")
    good, bad = split_downloads(dl)
    assert good.count() == 2 and [r["url"] for r in bad.collect()] == ["u2"]


def test_sinks_documents_csv_manifest(spark, tmpdir_path):
    from stresscast.functions.scalar import parse_utc_strict
    from stresscast.sources.sinks import price_documents, station_day_documents, storage_documents, write_csv
    sd = spark.createDataFrame([("S1", dt.date(2024, 1, 1), 1.0, 0.0, 2.0, 30.0),
                                ("S9", dt.date(2024, 1, 1), None, None, None, None)],
                               "ghcnd_station_id string, date date, tavg_c double, tmin_c double, tmax_c double, hdd double")
    meta = spark.createDataFrame([("p", "S1", "Boston", "MA")],
                                 "pipeline string, ghcnd_station_id string, station_name string, state string")
    docs = {r["ghcnd_station_id"]: r for r in station_day_documents(sd, meta, "p", "2024-02-01 00:00:00").collect()}
    assert docs["S1"]["station_meta"]["station_name"] == "Boston" and docs["S9"]["station_meta"].asDict() == dict.fromkeys(
        ("pipeline", "ghcnd_station_id", "station_name", "state"))  # unknown station: an empty document, not NULL
    assert docs["S1"]["source"]["provider"] == "NOAA" and docs["S1"]["date"] == "2024-01-01"
    pr = spark.createDataFrame([("2024-01-01", 2.5, "", "$/MMBTU")],
                               "date string, henry_hub_usd_per_mmbtu double, series string, units string")
    assert price_documents(pr, "2024-02-01").first()["series"] == "RNGWHHD"  # K5: empty series -> default
    stg = spark.createDataFrame([("2024-01-05", "lower48", 3000.0, "NW2")],
                                "date string, region string, working_gas_bcf double, series string")
    assert storage_documents(stg, "2024-02-01").first()["value"] == 3000.0
    write_csv(sd, f"{tmpdir_path}/csv")
    back = spark.read.option("header", True).csv(f"{tmpdir_path}/csv")
    assert back.count() == 2 and "tavg_c" in back.columns
    assert parse_utc_strict("2024-01-02").isoformat() == "2024-01-02T00:00:00+00:00"
    with pytest.raises(ValueError):
        parse_utc_strict("yesterday")


def test_run_manifest_is_verified(spark, tmpdir_path):
    import glob
    import shutil
    from stresscast.sources.sinks import read_run_manifest, write_run_manifest
    days = spark.createDataFrame([("p", "r1", f"S{i % 40}", "name", None if i % 3 else "MA") for i in range(200)]
                                 + [("q", "r2", "S1", None, None)],
                                 "pipeline string, region_id string, ghcnd_station_id string, station_name string, state string")
    path = f"{tmpdir_path}/manifest"
    write_run_manifest(days.repartition(7), path, now="2024-02-01 00:00:00", outputs={"a": "b"}, aggregation={"tavg": "median"},
                       date_filter={"start": "2024-01-01", "end": None})
    header, stations = read_run_manifest(spark, path)
    got = {r["pipeline"]: r for r in header.collect()}
    assert got["p"]["stations_count"] == 40 and got["q"]["stations_count"] == 1
    assert got["p"]["generated_at_utc"] == "2024-02-01T00:00:00Z" and got["p"]["outputs"]["a"] == "b"
    assert got["p"]["date_filter"].asDict() == {"start": "2024-01-01", "end": ""}
    assert {(r["pipeline"], r["ghcnd_station_id"]) for r in stations.collect()} == {("p", f"S{i}") for i in range(40)} | {("q", "S1")}
    shutil.copy(glob.glob(f"{path}/stations/of=q/*.json")[0], f"{path}/stations/of=q/again.json")
    with pytest.raises(ValueError, match="manifest of q"):
        read_run_manifest(spark, path)
    write_run_manifest(days.where("false"), f"{tmpdir_path}/none", now="2024-02-01", outputs={"a": ""}, aggregation={"a": ""},
                       date_filter={"a": None})


def test_capacity_files_with_damaged_rows_and_own_headers(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/a b/c")
    with open(f"{tmpdir_path}/a b/c/one.csv", "wb") as f:
        f.write(b'Loc_Name,Post_Date,TSP\r\n"A, ""x""",2024-01-01,1\r\nB\xe9,2024-01-01,1\r\nshort,2024-01-01\r\n'
                b'long,2024-01-01,1,2,3\r\n\r\nC\xc3\xa9, 2024-01-02 ,1\r\n')
    with open(f"{tmpdir_path}/a b/two.csv", "wb") as f:
        f.write(b"\xef\xbb\xbfTSP,Post_Date,Loc_Name,More\n2,2024-01-03,D,m\n")
    with open(f"{tmpdir_path}/a b/three.csv", "wb") as f:
        f.write(b"nothing here\n1,2\n")
    got = {r["Loc_Name"]: r for r in read_capacity_csv(spark, f"{tmpdir_path}/a b").collect()}
    assert set(got) == {'A, "x"', "B\ufffd", "short", "long", "Cé", "D"}
    assert {k for k, r in got.items() if r["_corrupt_record"]} == {"short", "long"}
    assert got["short"]["TSP"] is None and got["long"]["TSP"] == "1" and got["Cé"]["Post_Date"] == "2024-01-02"
    assert got["D"]["TSP"] == "2" and got["D"]["More"] == "m" and got["Cé"]["More"] is None
    assert got["D"]["source_url"].endswith("two.csv")


def test_checks_raise_in_the_writing_job(spark):
    from stresscast.operators.checks import FailedCheck, checked
    df = spark.range(50).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"))
    known = {"known x": (F.col("x").isNotNull(), 25)}
    assert checked(df, "rows", 50, ["id", "x"], known).count() == 50
    with pytest.raises(FailedCheck, match="50 rows of at least 51"):
        checked(df, "rows", 51)
    with pytest.raises(FailedCheck, match="25 known x of at least 26") as e:
        checked(df, "rows", 1, at_least={"known x": (F.col("x").isNotNull(), 26)})
    assert e.value.found == {"rows": 50, "known x": 25}
    with pytest.raises(FailedCheck, match="no column y, z"):
        checked(df, "rows", 1, ["z", "y"])
    with pytest.raises(FailedCheck, match="0 rows"):
        checked(df.where("false"), "rows")


def test_station_header_test_is_cheap_for_data_lines(spark):
    """Every line of a station file is asked whether it is the header: only lines with the letters are taken apart."""
    from stresscast.sources.stations import _is_header
    lines = spark.createDataFrame([("2024-01-01,50",), ('"STATION","DATE"',), ("UPDATE,x",), ("\ufeffDATE,TAVG",)], "value string")
    assert [r[0] for r in lines.select(_is_header(F.col("value"))).collect()] == [False, True, False, True]
    plan = lines.where(_is_header(F.col("value")))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(value" in plan
