"""Tables with a manifest: bytes follow the batch, and failures, retries, races and rereads lose and repeat nothing."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from stresscast.sources import manifest
from stresscast.sources.manifest import merge_table, read_current, snapshot

NOW, KEYS = "2024-06-01 00:00:00", ["station", "date"]
SCHEMA = "station string, date string, value double, seq int"


def days(spark, numbers, seq, value=1.0, stations=("a", "b")):
    return spark.createDataFrame([(s, f"2024-01-{d:02d}", value, seq) for d in numbers for s in stations], SCHEMA)


def merge(spark, root, batch, **more):
    return merge_table(spark, root, batch, KEYS, NOW, ["seq"], "date", **more)


def held(spark, root):
    return {(r["station"], r["date"]): r["value"] for r in read_current(spark, root).collect()}


def data_files(root):
    return {f: os.path.getsize(f) for f in glob.glob(f"{root}/data/**/*.parquet", recursive=True)}


def test_a_batch_writes_the_partitions_it_touches(spark, tmpdir_path):
    root = f"{tmpdir_path}/t"
    assert merge(spark, root, days(spark, range(1, 21), 1))["parts_written"] == 20
    first, before = data_files(root), {r["path"]: r for r in snapshot(spark, root).files().collect()}
    got = merge(spark, root, days(spark, [7], 2, 5.0).unionByName(days(spark, [25], 2, 6.0)))
    assert got == {"inserted": 2, "modified": 2, "unchanged": 0, "kept": 0, "unkeyed": 0, "upserts_or_updates": 4,
                   "parts_written": 2}
    new = {f: n for f, n in data_files(root).items() if f not in first}
    assert all("_p=p-2024-01-07" in f or "_p=p-2024-01-25" in f for f in new)
    assert sum(new.values()) < 0.2 * sum(first.values())
    after = {r["path"]: r for r in snapshot(spark, root).files().collect()}
    assert {r["part"] for p, r in before.items() if p not in after} == {"p-2024-01-07"}
    assert {r["version"] for p, r in after.items() if p in before} == {0}
    now = held(spark, root)
    assert len(now) == 42 and now["a", "2024-01-07"] == 5.0 and now["b", "2024-01-25"] == 6.0 and now["a", "2024-01-08"] == 1.0
    assert len(snapshot(spark, root, 0).read().collect()) == 40  # an earlier version can still be read


def test_a_retried_epoch_and_a_second_feed(spark, tmpdir_path):
    root = f"{tmpdir_path}/t"
    merge(spark, root, days(spark, [1, 2], 1), feed="x", epoch=0)
    assert merge(spark, root, days(spark, [1, 2], 1, 9.0), feed="x", epoch=0) is None
    assert merge(spark, root, days(spark, [2, 3], 2, 3.0), feed="y", epoch=0)["modified"] == 2
    assert merge(spark, root, days(spark, [4], 3, 4.0), feed="x", epoch=1)["inserted"] == 2
    assert snapshot(spark, root).last_epoch("x") == 1 and snapshot(spark, root).last_epoch("y") == 0
    assert [held(spark, root)["a", f"2024-01-0{d}"] for d in (1, 2, 3, 4)] == [1.0, 3.0, 3.0, 4.0]
    # rows that come before the stored ones change nothing
    assert merge(spark, root, days(spark, [2], 1, 0.5))["modified"] == 0
    assert held(spark, root)["a", "2024-01-02"] == 3.0


@pytest.mark.parametrize("step", ["_write_parts", "_publish", "_swap"])
def test_a_failure_before_the_swap_leaves_the_table(spark, tmpdir_path, monkeypatch, step):
    root = f"{tmpdir_path}/t"
    merge(spark, root, days(spark, [1, 2], 1), feed="x", epoch=0)
    before = held(spark, root)
    real = getattr(manifest, step)

    def fails(*args):
        if step == "_write_parts":
            real(*args)  # files are there, nothing lists them
        raise RuntimeError("lost")
    monkeypatch.setattr(manifest, step, fails)
    with pytest.raises(RuntimeError):
        merge(spark, root, days(spark, [2, 3], 2, 2.0), feed="x", epoch=1)
    assert held(spark, root) == before and snapshot(spark, root).version == 0
    monkeypatch.setattr(manifest, step, real)
    assert merge(spark, root, days(spark, [2, 3], 2, 2.0), feed="x", epoch=1)["inserted"] == 2
    assert held(spark, root) == {**before, **{(s, f"2024-01-0{d}"): 2.0 for s in "ab" for d in (2, 3)}}
    assert len(read_current(spark, root).collect()) == 6


@pytest.mark.parametrize("other", [[3], [2, 3]], ids=["other partitions", "same partition"])
def test_two_writers(spark, tmpdir_path, monkeypatch, other):
    """Another commit lands between this one's read and its swap: both batches are in the table, each once."""
    root = f"{tmpdir_path}/t"
    merge(spark, root, days(spark, [1, 2], 1))
    real, landed = manifest._swap, []

    def late(spark, at, staged, version):
        if not landed:
            landed.append(1)
            merge(spark, root, days(spark, other, 3, 3.0, ("b", "c")))
        real(spark, at, staged, version)
    monkeypatch.setattr(manifest, "_swap", late)
    got = merge(spark, root, days(spark, [2], 2, 2.0))
    assert snapshot(spark, root).version == 2 and got["parts_written"] == 1
    want = {("a", "2024-01-01"): 1.0, ("b", "2024-01-01"): 1.0, ("a", "2024-01-02"): 2.0, ("b", "2024-01-02"): 2.0}
    want |= {(s, f"2024-01-{d:02d}"): 3.0 for d in other for s in "bc"}
    assert held(spark, root) == want and len(read_current(spark, root).collect()) == len(want)


def test_new_columns_null_keys_and_odd_partition_names(spark, tmpdir_path):
    root = f"{tmpdir_path}/a table"
    rows = [("a", "2024-01-01 / %=", 1.0, 1), ("a", None, 2.0, 1), (None, "x", 3.0, 1), ("", "", 4.0, 1)]
    got = merge(spark, root, spark.createDataFrame(rows, SCHEMA))
    assert (got["inserted"], got["unkeyed"]) == (1, 3)
    wider = spark.createDataFrame([("a", "new", 5.0, 1, "u")], SCHEMA + ", units string")
    assert merge(spark, root, wider)["parts_written"] == 1
    found = {(r["station"], r["date"]): (r["value"], r["units"]) for r in read_current(spark, root).collect()}
    assert found == {("a", "2024-01-01 / %="): (1.0, None), ("a", None): (2.0, None), (None, "x"): (3.0, None),
                     ("", ""): (4.0, None), ("a", "new"): (5.0, "u")}
    # a field that is absent keeps its value
    merge(spark, root, spark.createDataFrame([("a", "new", 6.0, 2)], SCHEMA))
    assert read_current(spark, root).where("date = 'new'").select("value", "units").first()[:] == (6.0, "u")


def test_partitions_must_follow_the_keys(spark, tmpdir_path):
    with pytest.raises(Exception, match="value"):
        merge_table(spark, f"{tmpdir_path}/t", days(spark, [1], 1), KEYS, NOW, ["seq"], "value")
    assert read_current(spark, f"{tmpdir_path}/t") is None


def test_empty_batch(spark, tmpdir_path):
    root = f"{tmpdir_path}/t"
    merge(spark, root, days(spark, [1], 1))
    assert merge(spark, root, days(spark, [], 2).where(F.lit(False)), feed="x", epoch=3)["parts_written"] == 0
    assert snapshot(spark, root).last_epoch("x") == 3 and len(held(spark, root)) == 2


def test_rows_with_empty_keys_are_appended_once(spark, tmpdir_path):
    """Stored rows without a key are not matched: neither do they multiply a new one nor hold an earlier one back."""
    root = f"{tmpdir_path}/t"
    for rows in ([("", "x", 1.0, 5), ("", "x", 2.0, 5)], [("", "x", 3.0, 5)], [("", "x", 4.0, 1)]):
        assert merge(spark, root, spark.createDataFrame(rows, SCHEMA))["unkeyed"] == len(rows)
    assert sorted(r["value"] for r in read_current(spark, root).collect()) == [1.0, 2.0, 3.0, 4.0]
