"""The operators of this subpackage over whole tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.conversation_trie import conversation_trie
from churnlens.llm.decontaminate import benchmark_matches
from churnlens.llm.exact_dedup import exact_dedup
from churnlens.llm.language_id import identify_languages
from churnlens.llm.line_dedup import dedup_units
from churnlens.llm.merge_dropout import encoded
from churnlens.llm.merkle import manifest
from churnlens.llm.phrase_dedup import dedup_phrases
from churnlens.llm.sharding import shard_documents
from churnlens.llm.simhash import simhash_groups
from churnlens.llm.suffix_tree_lm import score_texts
from churnlens.llm.token_count import token_counts
from churnlens.llm.warc import archive_pages


# Words that repeated sentences next to each other have together before they go.
MIN_REPEATED_WORDS = 30


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_units(_table(spark, sf_dir, "documents"), unit="sentence", min_words=MIN_REPEATED_WORDS)
    spans = F.transform("removed", lambda span: F.concat_ws("-", span["start"], span["stop"]))
    return kept.select("doc_id", "text", "n_units", "n_removed", F.concat_ws(",", spans).alias("removed"))


def op3_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"), shards=40)


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive_pages(_table(spark, sf_dir, "pages"))
    # What a response states is worked out again from the payload that was read.
    return read.select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = encoded(_table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", F.size("piece_ids").alias("n_pieces"), F.xxhash64("piece_ids").alias("piece_hash"), "lossless"
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op10_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = F.when(marked, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    return manifest(_table(spark, sf_dir, "documents"), tampered=tampered).drop("path")


def op13_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = dedup_phrases(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: value for name, value in list(globals().items()) if name.startswith("op")
}
