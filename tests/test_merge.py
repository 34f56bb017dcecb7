import datetime as dt

import pytest
from pyspark.sql import functions as F

from stresscast.operators.merge import keyed_merge, merge_stats, stored
from tests.conftest import rows

NOW = "2024-06-01 00:00:00"


def existing(spark):
    return spark.createDataFrame(
        [("s", "2024-01-01", 1.0, "u1", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)),
         ("s", "2024-01-02", 2.0, "u2", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)),
         ("s", "2024-01-03", 3.0, "u3", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "series string, date string, value double, units string, created_at_utc timestamp_ntz, updated_at timestamp_ntz")


def batch(spark):
    # units absent from the batch; one key twice (later seq wins); a null value; null and empty keys
    return spark.createDataFrame(
        [("s", "2024-01-02", 20.0, 1), ("s", "2024-01-02", 21.0, 2), ("s", "2024-01-03", None, 1),
         ("s", "2024-01-04", 4.0, 1), (None, "2024-01-05", 5.0, 1), ("", "2024-01-06", 6.0, 1),
         ("s", "2024-01-01", 1.0, 1)],
        "series string, date string, value double, seq int")


def test_merge_semantics(spark):
    m = keyed_merge(existing(spark), batch(spark), ["series", "date"], NOW, order_cols=["seq"])
    out = {(r["series"], r["date"]): r for r in m.collect()}
    assert out[("s", "2024-01-02")]["value"] == 21.0 and out[("s", "2024-01-02")]["_action"] == "update"
    assert out[("s", "2024-01-02")]["units"] == "u2"  # absent field keeps the stored value
    assert out[("s", "2024-01-02")]["created_at_utc"] == dt.datetime(2024, 1, 1)
    assert out[("s", "2024-01-03")]["value"] is None  # present NULL overwrites
    assert out[("s", "2024-01-04")]["_action"] == "insert"
    assert out[("s", "2024-01-04")]["created_at_utc"] == dt.datetime(2024, 6, 1)
    assert out[("s", "2024-01-01")]["_action"] == "unchanged"
    unk = [r for r in m.collect() if r["_action"] == "unkeyed"]
    assert len(unk) == 2  # bad keys are kept, not merged
    st = merge_stats(m).first()
    assert (st["inserted"], st["modified"], st["unchanged"], st["unkeyed"]) == (1, 2, 1, 2)
    assert st["upserts_or_updates"] == 3


def test_merge_twice_is_idempotent(spark):
    good = batch(spark).where("series <> ''")
    once = stored(keyed_merge(existing(spark), good, ["series", "date"], NOW, ["seq"])).where("series IS NOT NULL")
    twice = keyed_merge(once, good, ["series", "date"], NOW, ["seq"])
    acts = {r["_action"] for r in twice.where("series IS NOT NULL").collect()}
    assert acts <= {"unchanged", "keep"}
    a = rows(once.drop("updated_at"), "series", "date")
    b = rows(stored(twice).where("series IS NOT NULL").drop("updated_at"), "series", "date")
    assert a == b


def test_fields_col_per_row_absence(spark):
    inc = spark.createDataFrame([("s", "2024-01-01", 9.0, "x", ["series", "date", "units"])],
                                "series string, date string, value double, units string, _fields array<string>")
    m = keyed_merge(existing(spark), inc, ["series", "date"], NOW, [F.col("value")], fields_col="_fields")
    r = [x for x in m.collect() if x["date"] == "2024-01-01"][0]
    assert r["value"] == 1.0 and r["units"] == "x"


def test_the_order_is_required_and_decides(spark):
    inc = spark.createDataFrame([("s", "2024-01-09", 1.0), ("s", "2024-01-09", 2.0)],
                                "series string, date string, value double")
    with pytest.raises(ValueError):
        keyed_merge(existing(spark), inc, ["series", "date"], NOW, [])
    for part in (inc, inc.orderBy("value"), inc.orderBy(F.desc("value"))):
        m = keyed_merge(existing(spark), part, ["series", "date"], NOW, [F.col("value")])
        got = [r for r in m.collect() if r["date"] == "2024-01-09"]
        assert len(got) == 1 and got[0]["value"] == 2.0


DOC = "k string, n int, meta struct<name:string,geo:struct<state:string,zip:int>>"


def docs(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


def merged_docs(existing, incoming, **more):
    out = keyed_merge(existing, incoming, ["k"], NOW, [F.col("n")], **more).collect()
    return {r["k"]: (r["n"], r["meta"] and r["meta"].asDict(True), r["_action"]) for r in out}


def test_nested_fields_are_merged_one_by_one(spark):
    old = docs(spark, [("a", 1, ("A", ("MA", 1))), ("b", 1, None), ("c", 1, ("C", None)), ("d", 1, ("D", ("NY", 4)))])
    sent = docs(spark, [("a", 1, (("NH",),)), ("b", 2, (("VT",),)), ("c", 1, (None,)), ("e", 5, (("ME",),))],
                "k string, n int, meta struct<geo:struct<state:string>>")
    got = merged_docs(old, sent)
    assert got["a"] == (1, {"name": "A", "geo": {"state": "NH", "zip": 1}}, "update")
    assert got["b"] == (2, {"name": None, "geo": {"state": "VT", "zip": None}}, "update")
    assert got["c"] == (1, {"name": "C", "geo": None}, "unchanged")  # a struct that is sent as NULL
    assert got["d"] == (1, {"name": "D", "geo": {"state": "NY", "zip": 4}}, "keep")
    assert got["e"] == (5, {"name": None, "geo": {"state": "ME", "zip": None}}, "insert")


def test_nested_fields_named_per_row(spark):
    old = docs(spark, [(k, 1, ("A", ("MA", 1))) for k in "abcd"])
    sent = docs(spark, [("a", 2, ("X", ("NH", 9)), ["k", "n", "meta.geo.state"]), ("b", 2, ("X", ("NH", 9)), ["k", "meta.name"]),
                        ("c", 2, None, ["k", "meta"]), ("d", 2, ("X", None), ["k", "meta"])], DOC + ", f array<string>")
    got = merged_docs(old, sent, fields_col="f")
    assert got["a"][:2] == (2, {"name": "A", "geo": {"state": "NH", "zip": 1}})
    assert got["b"][:2] == (1, {"name": "X", "geo": {"state": "MA", "zip": 1}})
    assert got["c"][:2] == (1, None) and got["d"][:2] == (1, {"name": "X", "geo": None})


def test_new_nested_fields_and_flattening(spark):
    from stresscast.operators.merge import flattened
    old = docs(spark, [("a", 1, ("A",)), ("b", 1, ("B",))], "k string, n int, meta struct<name:string>")
    out = keyed_merge(old, docs(spark, [("a", 1, ("A2", ("MA", 2)))]), ["k"], NOW, [F.col("n")])
    flat = {r["k"]: r for r in flattened(out).collect()}
    assert flattened(out).columns[:5] == ["k", "n", "meta_name", "meta_geo_state", "meta_geo_zip"]
    assert (flat["a"]["meta_name"], flat["a"]["meta_geo_zip"]) == ("A2", 2)
    assert (flat["b"]["meta_name"], flat["b"]["meta_geo_zip"]) == ("B", None)
