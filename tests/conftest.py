import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stresscast.session import get_session
    s = get_session("local[4]", 4)
    # Tests own their checkpoint folder only because none is configured here.
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="stresscast-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="stresscast-test-")


@pytest.fixture(params=[1, 3, 40])
def ranges(spark, request):
    """So many tasks an exchange, none merged: small tables are cut into as many ranges as a large one."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in keep.items():
        spark.conf.set(k, v)


def rows(df, *order):
    """Collect as a list of dicts sorted by ``order`` columns."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[c] is None, r[c]) for c in order))
    return out
