import datetime as dt

from pyspark.sql import functions as F

from stresscast.sources.pages import Selector, detail_fields, extract_detail, extract_list_rows, list_notices

LIST = """<html><body><table>
<tr><th>Type</th><th>Posted</th><th>Link</th><th>x</th></tr>
<tr><td>A</td><td> 3/10/2025 9:00:00 AM </td><td><a href="NoticeDetail.asp?id=1">d</a></td><td>z</td></tr>
<tr><td>B</td><td>garbage</td><td><a href="NoticeDetail.asp?id=2">d</a></td><td>z</td></tr>
<tr><td>C</td><td>3/09/2025 9:00:00 AM</td><td>no link here</td><td><a href="/Notice/3">d</a></td></tr>
<tr><td>D</td><td>3/01/2025 9:00:00 AM</td><td><a href="NoticeDetail.asp?id=4">d</a></td><td>z</td></tr>
<tr><td>E</td><td>3/11/2025 9:00:00 AM</td><td><a href="NoticeDetail.asp?id=5">d</a></td><td>z</td></tr>
</table></body></html>"""

DETAIL = """<html><body><div id="ctl_headingData"><span>AGT</span><span> Algonquin </span><span>Critical</span>
<span>03/10/2025</span><span>8:00:00 AM</span><span>03/12/2025</span><span>5:00:00 PM</span><span>12345</span>
<span>Initiate</span><span>Maintenance</span><span>03/10/2025</span><span>9:00:00 AM</span><span> </span>
<span>None</span></div><div id="bulletin1"><p>Body &amp; text</p></div></body></html>"""


def pages(spark):
    return spark.createDataFrame([(1, "https://x.example/list/index.asp", LIST),
                                  (2, "https://x.example/d/NoticeDetail.asp?id=1", DETAIL),
                                  (3, "https://x.example/short", "<div id='headingData'>a<b>b</b></div>")],
                                 "page_id long, url string, html string")


def test_list_rows_and_take_while(spark):
    lr = extract_list_rows(pages(spark).where("page_id = 1"))
    got = [(r["row_pos"], r["detail_url"]) for r in lr.orderBy("row_pos").collect()]
    assert got[0] == (0, "https://x.example/list/NoticeDetail.asp?id=1")
    assert got[2] == (2, "https://x.example/Notice/3")  # no link in the second-last cell: first link
    kept = [r["row_pos"] for r in list_notices(lr, "2025-03-05").orderBy("row_pos").collect()]
    assert kept == [0, 2]  # row 1 has no parsable time (skipped); row 3 is older: stop, row 4 is not reached


def test_detail_fields(spark):
    d = detail_fields(extract_detail(pages(spark).where("page_id >= 2")))
    r = {x["page_id"]: x for x in d.collect()}
    a = r[2]
    assert (a["tsp"], a["name"], a["critical"], a["notice_id"], a["status"], a["type"]) == \
        ("AGT", "Algonquin", "Y", "12345", "initiate", "maintenance")
    assert a["effective_dt"].replace(tzinfo=None) == dt.datetime(2025, 3, 10, 8, 0)
    assert a["end_dt"].replace(tzinfo=None) == dt.datetime(2025, 3, 12, 17, 0)
    assert a["prior_id"] == "None" and a["subject"] == ""  # blank node dropped: later fields shift (kept quirk)
    assert a["body"] == '<div id="bulletin1"><p>Body &amp; text</p></div>'
    b = r[3]
    assert b["n_heading"] == 2 and b["notice_id"] == "" and b["body"] == ""


def test_stream_ingest_idempotent(spark, tmpdir_path):
    from stresscast.sources.energy import normalize_prices
    from stresscast.streaming.ingest import ingest, read_current
    schema = "period string, value string, series string, seq int"
    land, table = f"{tmpdir_path}/landing", f"{tmpdir_path}/table"
    night1 = [("2024-01-01", "1.0", "RNGWHHD", 1), ("2024-01-02", "2.0", "RNGWHHD", 2)]
    night2 = [("2024-01-02", "2.5", "RNGWHHD", 3), ("2024-01-03", "3.0", "RNGWHHD", 4)]  # overlap: a correction
    spark.createDataFrame(night1, schema).write.parquet(f"{land}/night=1")
    sch = spark.read.parquet(f"{land}/night=1").schema
    args = (spark, land, sch, lambda r: normalize_prices(r, ["seq"]), table, ["series", "date"], f"{tmpdir_path}/ck",
            "2024-02-01 00:00:00", ["seq"], "substring(date, 1, 7)")
    s1 = ingest(*args)
    assert sum(s["inserted"] for s in s1) == 2
    spark.createDataFrame(night2, schema).write.parquet(f"{land}/night=2")
    s2 = ingest(*args)
    assert sum(s["inserted"] for s in s2) == 1 and sum(s["modified"] for s in s2) == 1
    t = {r["date"]: r["henry_hub_usd_per_mmbtu"] for r in read_current(spark, table).collect()}
    assert t == {"2024-01-01": 1.0, "2024-01-02": 2.5, "2024-01-03": 3.0}
    assert ingest(*args) == []  # nothing new landed: no batch, table unchanged

    # a second feed with its own checkpoint, whose epochs start at 0 again, and rows older than the stored ones
    other = f"{tmpdir_path}/other"
    spark.createDataFrame([("2024-01-05", "5.0", "RNGWHHD", 5), ("2024-01-02", "0.1", "RNGWHHD", 0)], schema).write.parquet(other)
    again = (spark, other, spark.read.parquet(other).schema, *args[3:6], f"{tmpdir_path}/ck2", *args[7:])
    assert sum(s["inserted"] for s in ingest(*again)) == 1
    t = {r["date"]: r["henry_hub_usd_per_mmbtu"] for r in read_current(spark, table).collect()}
    assert t == {"2024-01-01": 1.0, "2024-01-02": 2.5, "2024-01-03": 3.0, "2024-01-05": 5.0}
    # a replaced checkpoint reads everything again and changes nothing
    ingest(*args[:6], f"{tmpdir_path}/ck3", *args[7:])
    assert {r["date"]: r["henry_hub_usd_per_mmbtu"] for r in read_current(spark, table).collect()} == t


def test_stream_lookback_drops_resent_keys(spark, tmpdir_path):
    from stresscast.sources.energy import normalize_prices
    from stresscast.streaming.ingest import ingest, read_current

    def typed(df):
        return normalize_prices(df, ["seq"]).withColumn("_t", F.to_timestamp("date"))

    schema = "period string, value string, series string, seq int"
    land, table = f"{tmpdir_path}/landing", f"{tmpdir_path}/table"
    spark.createDataFrame([("2024-01-02", "2.0", "RNGWHHD", 2)], schema).write.parquet(f"{land}/night=1")
    sch = spark.read.parquet(f"{land}/night=1").schema
    args = (spark, land, sch, typed, table, ["series", "date"], f"{tmpdir_path}/ck", "2024-02-01 00:00:00", ["seq"], "date")
    ingest(*args, event_time="_t", lookback="60 days")
    spark.createDataFrame([("2024-01-02", "9.0", "RNGWHHD", 9)], schema).write.parquet(f"{land}/night=2")
    ingest(*args, event_time="_t", lookback="60 days")
    t = {r["date"]: r["henry_hub_usd_per_mmbtu"] for r in read_current(spark, table).collect()}
    assert t == {"2024-01-02": 2.0}  # the re-sent key inside the lookback was dropped, not merged


def test_entities_do_not_split_heading_nodes(spark):
    from stresscast.sources.pages import Selector, extract_detail
    html = '<div id="headingData"><span>TSP</span><span>Smith &amp; Co &#233;</span><b>x</b>&lt;y</div>'
    pages = spark.createDataFrame([(1, "http://h.example/1", html)], "page_id long, url string, html string")
    assert extract_detail(pages, heading=Selector("div", "headingData")).first()["heading"] == ["TSP", "Smith & Co é", "x", "<y"]
