"""Registered queries of the dealt operators, with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stresscast.llm import (chat_snapshots, decision_list, filter_audit, mixing, packing, page_diff, pu_quality,
                            secret_scan, simhash, suffix_dedup, token_transducer, whitening, wu_manber)
from stresscast.llm.common import read_table


def op1_page_diff_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page of ``pages``."""
    found = page_diff.extract_main_text(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of ``documents``, learned from positive and unlabelled texts."""
    return pu_quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_randomness_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in ``documents``: known shapes and runs of characters that the randomness tests find."""
    found = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.as_text(F.col("spans")).alias("spans"))


def op4_sainte_lague_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents`` to the weights 5, 2, 1 over the sources."""
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op5_decision_list_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of ``documents`` and the verdict of rules learned from ``labels``."""
    found = decision_list.judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "rule")


def op6_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of ``documents`` by 13-word windows of ``benchmark``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wu_manber.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_chat_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations of ``conversations``, rendered."""
    return chat_snapshots.render_conversations(read_table(spark, sf_dir, "conversations"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates of ``documents``: 4-word shingles, at most 4 differing bits."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` covered by 200-byte strings that start more than once."""
    found = suffix_dedup.repeated_bytes(read_table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        "kept_sha256")


def op10_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of ``documents`` by the word-end BPE of 49k tokens; texts over 2048 tokens are marked."""
    import public_tokenizers
    found = token_transducer.token_counts(read_table(spark, sf_dir, "documents"),
                                          public_tokenizers.path("word_bpe_49k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)


def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` on their 16 leading principal components, whitened."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=16, scale=64, shift=1_000_000)


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of ``documents`` in each of their 120 orders, by language."""
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` as tokens of the byte-level BPE of 50k, packed into windows of 1024."""
    import public_tokenizers
    found = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), window=1024)
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_page_diff_text": op1_page_diff_text,
    "op2_pu_quality": op2_pu_quality,
    "op3_randomness_secret_scan": op3_randomness_secret_scan,
    "op4_sainte_lague_mixing": op4_sainte_lague_mixing,
    "op5_decision_list_rules": op5_decision_list_rules,
    "op6_wu_manber_decontamination": op6_wu_manber_decontamination,
    "op7_chat_snapshot_collapse": op7_chat_snapshot_collapse,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_suffix_merge_dedup": op9_suffix_merge_dedup,
    "op10_transducer_token_counts": op10_transducer_token_counts,
    "op11_feast_whitening": op11_feast_whitening,
    "op12_filter_interaction_audit": op12_filter_interaction_audit,
    "op13_best_fit_packing": op13_best_fit_packing,
}
