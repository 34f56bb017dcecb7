"""Spark session and checkpoint-directory policy.

The engine never builds its own cluster settings beyond what a query needs to
be correct (UTC session zone, ANSI on, AQE on). Cluster sizing belongs to the
deployment.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every query in this package relies on for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows that carry a model's draws are large: a batch for Python ends by its bytes
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "stresscast", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false")
    b = b.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged writes.

    Uses ``spark.checkpoint.dir`` from the session. Only when it is unset *and*
    the master is local (tests, benches) a fresh scratch folder is created; on a
    cluster an unset value is an error, because a machine-local folder is not
    visible to other executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="stresscast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss).

    The plan is persisted (memory and disk) while the checkpoint is written, so
    it is computed once: without it Spark runs the plan for the eager count and
    again to write the checkpoint files.
    """
    from pyspark import StorageLevel
    checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared checkpoint folder for staged tables (not created here)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared checkpoint folder; the plan runs once, every executor reads it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
