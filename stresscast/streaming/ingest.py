"""Idempotent incremental ingest with lookback (ST1).

The source re-reads the last N days every night and upserts by key, which is
how late and corrected rows get in. Here: landed files are read with
``readStream``; every micro-batch is normalized and merged by key into a table
with a manifest (``sources/manifest.py``) with ``foreachBatch``;
``trigger(availableNow=True)`` processes what has landed and stops (a scheduled
job), and the stream checkpoint makes a rerun pick up only new files.

A batch reads and writes the partitions its keys fall into and no others. Its
commit records the stream (the id that Spark keeps in the stream's checkpoint)
with the epoch: a retried epoch of the same stream is skipped, so a batch is
applied once even after a failure between write and commit, and another feed or
a fresh checkpoint, whose epochs start at 0 again, is applied like any other.

Which row of a key wins is decided by ``order_cols`` alone, within a batch and
against the stored row, so the table does not depend on how files were dealt
into batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from stresscast.sources.manifest import merge_table, read_current  # noqa: F401


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote into a stream's checkpoint when it first started."""
    text = "".join(r.value for r in spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect())
    return json.loads(text)["id"]


def ingest(spark: SparkSession, source: str, schema: StructType, normalize: Callable[[DataFrame], DataFrame],
           table_root: str, keys: Sequence[str], checkpoint: str, now, order_cols: Sequence[str],
           partition_by: Column | str, fmt: str = "parquet", max_files_per_trigger: int | None = None,
           event_time: str | None = None, lookback: str | None = None) -> list[dict]:
    """Run the stream until everything landed so far is merged; returns per-batch statistics.

    ``partition_by`` is an expression over ``keys`` (a day or a month, say). With ``event_time`` and ``lookback`` (e.g.
    '60 days') a key re-sent within the lookback is dropped instead of merged (``dropDuplicatesWithinWatermark``; use
    it when late rows must not overwrite: the default merge applies corrections).
    """
    stats: list[dict] = []
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = normalize(reader.load(source))
    if event_time and lookback:
        rows = rows.withWatermark(event_time, lookback).dropDuplicatesWithinWatermark(list(keys))

    def each(batch: DataFrame, epoch: int):
        s = merge_table(spark, table_root, batch, keys, now, order_cols, partition_by,
                        feed=stream_id(spark, checkpoint), epoch=epoch)
        if s is not None:
            stats.append({"epoch": epoch, **s})

    q = (rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return stats
