"""Training corpus from raw documents: a chain of stages, each on all the last one kept.

Every stage but the last returns rows of its input with all its columns, extra ones and
those with names that operators use inside included.

Defined results: null text counts as empty and is judged like it; null doc_id has no label,
is the last choice of a near-duplicate group and is drawn by its text; of repeated rows
one stays after the near-duplicates; null source is a source of its own; a document that
the benchmark contaminates goes with all its copies; the mix may repeat a document or leave
it out, by its source's rate; without labels the classifier keeps all, without a benchmark
nothing is contaminated; an empty table gives an empty table in every stage. The store holds
documents in ascending doc_id, null first, whatever order they come in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnloom.llm import decontamination, mixing, quality_classifier, simhash, token_store
from churnloom.llm.common import table
from churnloom.llm.queries import TOKENIZER
from churnloom.session import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_classifier.remove_rejected(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def weighted_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the sources get their target weights, shuffled."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in a store; returns what is read back from it."""
    path = scratch(spark, "tokens")
    token_store.write_store(docs, path, TOKENIZER)
    return token_store.read_digest(spark, path)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates by SimHash", near_duplicates),
    ("benchmark decontamination", clean_of_benchmark),
    ("mixing to target weights", weighted_mix),
    ("token-ID / binary output", token_output),
]

#: A trained classifier decides which documents stay; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
