"""A training corpus from raw documents: five stages, each a whole-table operator of ``stresscast.llm``.

Every stage gets what the one before it kept, written as Parquet and read again. All but the last return the columns
of the documents; the last returns the mix: which documents are taken, and how many of their words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stresscast.llm import mixing, pu_quality, secret_scan, simhash, wu_manber
from stresscast.llm.common import read_table, staged


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier does not reject (fitted on these documents)."""
    labels = read_table(spark, sf_dir, "labels")
    model = pu_quality.fit(pu_quality.feature_table(docs), pu_quality.learnable(labels))
    return docs.where(pu_quality.score_column(model, docs["text"]) >= 0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of SimHash near-duplicates."""
    return simhash.one_of_each_group(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows."""
    found = wu_manber.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select("row.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and their lengths counted again."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents of which words are taken, with their source's target."""
    return mixing.mix(docs).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mixing_to_weights),
]

#: The classifier's fit and the 64-bit fingerprints have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
