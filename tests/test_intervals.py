import datetime as dt
import random

from stresscast.operators.intervals import stress_from_notices, stress_from_notices_sweep, unusable_notices
from tests.conftest import rows

SCHEMA = "pipeline string, notice_id string, posted_dt timestamp, effective_dt timestamp, end_dt timestamp, critical boolean"


def T(d, h=0):
    return dt.datetime(2024, 1, d, h)


def fixture(spark):
    data = [
        ("p", "no_eff", T(1, 5), None, T(2), False),          # effective <- posted
        ("p", "no_end", T(3), T(3, 22), None, True),           # end <- effective (same day)
        ("p", "neither", None, None, None, True),              # unusable: quarantined
        ("p", "backwards", T(5), T(6), T(4), True),            # end before start: no days
        ("p", "copy", T(1), T(2), T(4), False),                # overlapping copies of one id
        ("p", "copy", T(1), T(3), T(6), True),
        ("p", "nullcrit", T(8), T(8), T(9), None),
        ("q", "other", T(2), T(2), T(2), False),               # second pipeline
        ("q", None, T(4), T(4), T(5), True),                   # NULL id: covers days, flags critical, no count
        ("q", None, T(5), T(5), T(6), False),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_expand_semantics(spark):
    out = rows(stress_from_notices(fixture(spark)), "pipeline", "date")
    by = {(r["pipeline"], r["date"].day): (r["notice_active_count"], r["critical_active"]) for r in out}
    assert by[("p", 1)] == (1, 0)            # no_eff from the posted day
    assert by[("p", 2)] == (2, 0)            # no_eff + copy
    assert by[("p", 3)] == (2, 1)            # no_end same day (critical) + copy (critical copy covers 3..6)
    assert by[("p", 4)] == (1, 1)            # copy counted once although two copies cover it
    assert by[("p", 6)] == (1, 1)
    assert ("p", 7) not in by
    assert by[("p", 8)] == (1, 0) and by[("p", 9)] == (1, 0)   # null critical -> not critical
    assert by[("q", 2)] == (1, 0)
    assert by[("q", 4)] == (0, 1) and by[("q", 5)] == (0, 1) and by[("q", 6)] == (0, 0)
    assert all(r["stress_event"] == r["critical_active"] for r in out)
    assert unusable_notices(fixture(spark)).count() == 1


def test_sweep_equals_expand_fixture(spark):
    a = rows(stress_from_notices(fixture(spark)), "pipeline", "date")
    b = rows(stress_from_notices_sweep(fixture(spark)), "pipeline", "date")
    assert a == b


def test_sweep_equals_expand_random(spark):
    rnd = random.Random(7)
    data = []
    for i in range(400):
        pid = rnd.choice(["a", "b", "c"])
        nid = f"n{rnd.randrange(60)}" if rnd.random() > 0.05 else None
        s = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randrange(40), hours=rnd.randrange(24))
        e = s + dt.timedelta(days=rnd.randrange(-3, 12)) if rnd.random() > 0.1 else None
        eff = s if rnd.random() > 0.1 else None
        data.append((pid, nid, s, eff, e, rnd.random() < 0.3))
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(stress_from_notices(df), "pipeline", "date") == rows(stress_from_notices_sweep(df), "pipeline", "date")


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    for fn in (stress_from_notices, stress_from_notices_sweep):
        out = fn(df)
        assert out.count() == 0
        assert out.columns == ["pipeline", "date", "notice_active_count", "critical_active", "stress_event"]


def test_driver_views_agree(spark):
    from stresscast.sources.driver_views import notice
    n = notice(spark, "/root/testdata/sf0.001")
    assert rows(stress_from_notices(n), "pipeline", "date") == rows(stress_from_notices_sweep(n), "pipeline", "date")


def test_sweep_window_sees_a_notice_once(spark):
    """One row per id and start day goes to the window, not one per kind: two explodes are left (deltas and days)."""
    out = stress_from_notices_sweep(fixture(spark))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 2
