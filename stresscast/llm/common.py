"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresscast.session import checkpoint_dir

#: Words are maximal runs of anything but ASCII white space (fixed by the result contracts).
WORD_GAP = r"[\x20\x09-\x0D]+"


def docs_with(docs: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, so that extra columns of the input can never clash with an operator's own."""
    small_batches(docs)
    return docs.select(*[docs[c] for c in cols])


def words_of(text: Column) -> Column:
    """Array of the words of a text (null and blank texts: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def staging_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared checkpoint folder. Nothing is created here."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stresscast-{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, partition_by: str | None = None, options: dict | None = None) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared checkpoint folder; every executor can read it again.

    The tables are the session's scratch data: the folder may be emptied when its results are written. ``options`` go to the writer.
    """
    path = staging_path(df.sparkSession, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def process_cache() -> dict:
    """A dictionary of the Python process itself: what a task puts here serves the later tasks of its worker."""
    import types
    return vars(sys.modules.setdefault("_stresscast_process_cache", types.ModuleType("_stresscast_process_cache")))


#: Rows of a batch that travels to Python. Texts are long: Spark's default of 10,000 holds tens of MB at a time.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """The frame itself; from now on its session sends texts to Python in batches of at most ``BATCH_ROWS`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(name, "10000")) > BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))
    return df
