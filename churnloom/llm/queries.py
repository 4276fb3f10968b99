"""The operators as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom.llm import (
    chat,
    decontamination,
    hard_negatives,
    merkle,
    minhash,
    mixing,
    quality_classifier,
    quality_rules,
    secret_ledger,
    simhash,
    substring,
    token_counts,
    token_store,
)
from churnloom.llm.common import table
from churnloom.llm.oracle import SQL as SQL
from churnloom.session import scratch, stored

Query = Callable[[SparkSession, str], DataFrame]

#: A path outside the repository; the file is read by every worker.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("bigint").alias("path"), "text"
    )
    ledger = secret_ledger.Ledger(spark, scratch(spark, "ledger"))
    ledger.scan(docs)
    return ledger.paths(ledger.versions()).withColumnRenamed("path", "doc_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contamination(docs, items).drop("th")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_store.write_store(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_store.read_digest(spark, path)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_windows(table(spark, sf_dir, "documents")).drop("spans")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"))
    return found.select(
        *"doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words".split(),
        "base_failed",
        "kept",
        "quality",
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.scores(docs, labels)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored, so that whole documents are repeated and shuffled, not ids alone.
    drawn = stored(mixing.shuffled(table(spark, sf_dir, "documents")), "mixed")
    return drawn.select(
        "doc_id", "source", F.col("_copy").cast("bigint").alias("copy"), F.col("_order").alias("position")
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(spark, table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_secret_ledger": op1_secret_ledger,
    "op2_decontamination": op2_decontamination,
    "op3_token_store": op3_token_store,
    "op4_simhash": op4_simhash,
    "op5_token_counts": op5_token_counts,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_chat_format": op9_chat_format,
    "op10_mixing": op10_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_minhash": op12_minhash,
    "op13_hard_negatives": op13_hard_negatives,
}
