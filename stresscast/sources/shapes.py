"""CSV files that differ in their header, read by Spark's own reader.

One reader call gives all its files one header. Here the header rows are found first and files are grouped by
header; every distinct header (a few, however many files there are) gets one reader call over its files, with the
header as schema, and the results are united by name. No row is shuffled or joined to its file, unused columns are not
parsed, and one large file is split like any other (unless quoted line breaks must be read). The file names pass the driver,
as they do for any list of files.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def header_files(spark: SparkSession, paths: str | Sequence[str], is_header: Callable[[Column], Column],
                 encoding: str = "UTF-8") -> dict[str, list[str]]:
    """Files by header line. ``is_header`` recognizes the header among the lines of a file's first block.

    Of several such lines the first counts; a file without one is left out. Folders are searched to any depth.
    """
    lines = (spark.read.option("encoding", encoding).option("recursiveFileLookup", True).text([paths] if isinstance(paths, str) else list(paths))
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at")))
    found = (lines.where((F.col("block") == 0) & is_header(F.col("value")))
             .groupBy("file").agg(F.min_by("value", "at").alias("header")).collect())
    out: dict[str, list[str]] = {}
    for r in sorted(found, key=lambda r: r["file"]):
        out.setdefault(r["header"].lstrip("﻿"), []).append(r["file"])
    return out


def read_by_header(spark: SparkSession, paths: str | Sequence[str], is_header: Callable[[Column], Column],
                   columns: Sequence[str] | None = None, encoding: str = "UTF-8", line_breaks: bool = False) -> DataFrame:
    """Rows of CSV files with their own headers: all columns as text, ``_corrupt_record`` and ``file``.

    ``columns``: the columns of the result (a column that a file lacks is NULL); None gives every column of any header. Bytes that
    are not valid in ``encoding`` become U+FFFD. A row with too few or too many cells keeps those it has and has the line in
    ``_corrupt_record``; lines of white space only are no rows. ``line_breaks`` reads quoted line breaks; such files are not split.
    """
    parts, names = [], []
    for header, files in header_files(spark, paths, is_header, encoding).items():
        cells = [c.strip() for c in next(csv.reader([header]))]
        schema = StructType([StructField(c, StringType()) for c in [*cells, CORRUPT]])
        rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("encoding", encoding)
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("quote", '"')
                .option("escape", '"').option("multiLine", line_breaks).csv([_plain(f) for f in files]))
        names += [c for c in cells if c not in names]
        parts.append((cells, rows))
    wanted = list(names if columns is None else columns)
    united = [rows.select(*[F.trim(F.col(f"`{c}`")).alias(c) if c in cells else F.lit(None).cast("string").alias(c) for c in wanted],
                          CORRUPT, F.col("_metadata.file_path").alias("file")) for cells, rows in parts]
    if not united:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in [*wanted, CORRUPT, "file"]]))
    return reduce(DataFrame.unionByName, united)


def _plain(file: str) -> str:
    """A path that a reader takes literally: the metadata column's is encoded, and glob characters have a meaning to readers."""
    from urllib.parse import unquote
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in unquote(file))
