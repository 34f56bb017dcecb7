"""Tables whose partitions are replaced one at a time (ST1, K7).

A table is a folder with ``data/<commit>/`` (Parquet written by Spark, one sub-folder a partition) and
``manifest/v=<version>/`` (Parquet: the files that make up the table now, the last applied epoch of every feed, and the
schema). A commit writes the partitions its batch touches and the next manifest; it takes effect when the manifest's
folder is renamed to its version number, which the file system does wholly or not at all and only if that number is
free. So

* bytes written follow the batch: partitions without a key of the batch keep their files;
* a failure before the rename leaves files that no manifest lists, and the table as it was;
* of two writers only one gets a version; the other reads the new one and applies its batch to that;
* readers see one version.

The driver handles file names only: of the touched partitions for a merge, of the table for a read (as any scan does).
The rename needs a file system with an atomic one (HDFS, local); it goes through Spark's Hadoop classes, which a Spark Connect
client does not have.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stresscast.operators.merge import ACTIONS, bad_key, keyed_merge

_ENTRY = "kind string, name string, path string, rows long, version long"


class LostRace(Exception):
    """Another writer took the version."""


@dataclass(frozen=True)
class Snapshot:
    """One version of a table. Version -1 is a table without commits."""
    spark: SparkSession
    root: str
    version: int
    entries: DataFrame

    def schema(self) -> StructType | None:
        found = self.entries.where("kind = 'schema'").first()
        return StructType.fromJson(json.loads(found["path"])) if found else None

    def last_epoch(self, feed: str) -> int:
        found = self.entries.where((F.col("kind") == "feed") & (F.col("name") == feed)).first()
        return found["rows"] if found else -1

    def files(self) -> DataFrame:
        """``part``, ``path``, ``rows`` and ``version`` (the commit that wrote it) of every current file."""
        return self.entries.where("kind = 'file'").select(F.col("name").alias("part"), "path", "rows", "version")

    def read(self, parts: DataFrame | None = None) -> DataFrame | None:
        """The table, or its partitions named in the column ``part`` of ``parts``; None before the first commit."""
        schema = self.schema()
        if schema is None:
            return None
        files = self.files() if parts is None else self.files().join(parts, "part", "left_semi")
        paths = [f"{self.root}/data/{r['path']}" for r in files.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, spark.sparkContext._jsc.hadoopConfiguration()


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions in order."""
    _, p, conf = _hadoop(spark, f"{root.rstrip('/')}/manifest")
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v="))


def _manifest_path(root: str, version: int) -> str:
    return f"{root}/manifest/v={version:012d}"


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The current version of a table, or an earlier one."""
    root = root.rstrip("/")
    found = versions(spark, root)
    if version is None:
        version = found[-1] if found else -1
    elif version not in found:
        raise ValueError(f"no version {version} of {root}")
    entries = (spark.read.schema(_ENTRY).parquet(_manifest_path(root, version)) if version >= 0
               else spark.createDataFrame([], _ENTRY))
    return Snapshot(spark, root, version, entries)


def _swap(spark: SparkSession, root: str, staged: str, version: int) -> None:
    """Give a written manifest its version number: an atomic rename to a name that must be free."""
    jvm, source, conf = _hadoop(spark, staged)
    target = jvm.org.apache.hadoop.fs.Path(_manifest_path(root, version))
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), conf)
    try:
        files.rename(source, target, options)
    except Exception as e:  # py4j wraps the file system's own exception
        if "FileAlreadyExistsException" in str(e):
            raise LostRace(f"version {version} of {root}") from e
        raise


def part_label(partition_by: Column | str) -> Column:
    """Folder name of a partition value: its text in safe characters. Values that share a name share a partition."""
    value = F.expr(partition_by) if isinstance(partition_by, str) else partition_by
    return F.concat(F.lit("p-"), F.regexp_replace(F.coalesce(value.cast("string"), F.lit("~")), "[^A-Za-z0-9_.~-]", "_"))


def _write_parts(rows: DataFrame, root: str, label: Column) -> tuple[str, DataFrame]:
    """Write rows by partition; returns the commit's folder and its files with their rows by action.

    The rebalance hint gives a small partition one file and a hot one several.
    """
    spark = rows.sparkSession
    commit = uuid.uuid4().hex
    folder = f"{root}/data/{commit}"
    rows.withColumn("_p", label).hint("rebalance", "_p").write.partitionBy("_p").parquet(folder)
    written = spark.read.schema("_action string, _p string").parquet(folder)
    path = F.regexp_extract("_metadata.file_path", f"/data/({commit}/.*)$", 1)
    return folder, written.groupBy(F.col("_p").alias("part"), path.alias("path"), "_action").count()


def merge_table(spark: SparkSession, root: str, batch: DataFrame, keys: Sequence[str], now, order_cols: Sequence[str],
                partition_by: Column | str, feed: str = "", epoch: int | None = None,
                fields_col: str | None = None) -> dict | None:
    """Merge a batch by key into a table and commit; only partitions with a key of the batch are read and written.

    ``partition_by`` is an expression over ``keys``, so that a key never changes its partition. ``order_cols`` are
    columns of the batch and stored with it: the largest wins, and a stored row is not replaced by one that comes before
    it. With ``epoch`` the commit is recorded for ``feed``, and an epoch up to the recorded one is skipped (None).
    Rows with an absent, null or empty key field are appended to their partition.

    Returns the number of rows per action and of partitions written.
    """
    keys, root = list(keys), root.rstrip("/")
    label = part_label(partition_by)
    batch.select(*keys).select(label)  # fails if the expression needs other columns
    batch = batch.persist()
    try:
        parts = batch.select(label.alias("part")).distinct()
        while True:
            at = snapshot(spark, root)
            if epoch is not None and at.last_epoch(feed) >= epoch:
                return None
            stored = at.read(parts)
            existing = stored if stored is not None else batch.limit(0).drop(*([fields_col] if fields_col else []))
            rows = not_before(batch, stored, keys, order_cols) if stored is not None else batch
            merged = keyed_merge(existing, rows, keys, now, [F.col(c) for c in order_cols], fields_col)
            _, written = _write_parts(merged, root, label)
            written = written.persist()
            try:
                schema = merged.drop("_action").schema
                _publish(at, written, schema, feed, epoch)
                counts = {r["_action"]: r["n"] for r in written.groupBy("_action").agg(F.sum("count").alias("n")).collect()}
                n_parts = written.select("part").distinct().count()
            except LostRace:
                continue  # apply the batch to the version that won
            finally:
                written.unpersist()
            out = {name: counts.get(action, 0) for action, name in ACTIONS.items()}
            return {**out, "upserts_or_updates": out["inserted"] + out["modified"], "parts_written": n_parts}
    finally:
        batch.unpersist()


def not_before(batch: DataFrame, stored: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Rows of the batch that do not come before the stored row of their key."""
    keyed = stored.where(~bad_key(keys, columns=stored.columns))  # the rows without a key are most of a table, and none can match
    held = keyed.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*order_cols).alias("_held"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    late = F.col("_held").isNull() | (F.struct(*order_cols) >= F.col("_held"))
    return batch.join(held, same, "left").where(late).select(*batch.columns)


def _publish(at: Snapshot, written: DataFrame, schema: StructType, feed: str, epoch: int | None) -> None:
    """Write the manifest that follows ``at`` with the written partitions in place of their former files, and swap."""
    spark, version = at.spark, at.version + 1
    new = written.groupBy("part", "path").agg(F.sum("count").alias("rows"))
    files = (at.files().join(written.select("part").distinct(), "part", "left_anti")
             .unionByName(new.withColumn("version", F.lit(version).cast("long"))))
    other = [("schema", "", schema.json(), None, version)]
    former = at.entries.where("kind = 'feed'")
    if epoch is not None:
        former = former.where(F.col("name") != feed)
        other.append(("feed", feed, None, epoch, version))
    entries = (files.select(F.lit("file").alias("kind"), F.col("part").alias("name"), "path", "rows", "version")
               .unionByName(former).unionByName(spark.createDataFrame(other, _ENTRY)))
    staged = f"{at.root}/manifest/.next-{uuid.uuid4().hex}"
    entries.coalesce(1).write.parquet(staged)
    _swap(spark, at.root, staged, version)


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The table as of its last commit; None before the first."""
    return snapshot(spark, root).read()
