"""Stages of the pipeline on nulls, blanks, repeated rows, clashing names and empty tables."""

from collections import Counter

import pytest
from conftest import ODD
from pyspark.sql import functions as F

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
EXTRA = ["_text", "_copy", "_order", "_kept", "row", "key", "th", "fp", "n_words", "score", "label", "quality"]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(d, t, "de" if d else None, f"s{(d or 0) % 3}" if d != 5 else None, len(t or "")) for d, t in ODD]
    odd = spark.createDataFrame(rows + rows[:3], real.schema)
    both = real.unionByName(odd)
    return both.select("*", *[F.concat(F.lit(c), F.coalesce("text", F.lit("-"))).alias(c) for c in EXTRA])


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_keep_whole_rows(spark, docs):
    before, rows = docs, bag(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == docs.columns, name
        kept = bag(after)
        assert kept and set(kept) <= set(rows), name
        if "mix" not in name:
            assert not kept - rows, name
        if "near" in name:
            assert max(kept.values()) == 1
            assert sum(1 for r in kept if not (r[1] or "").strip()) <= 1
        before, rows = spark.createDataFrame(list(kept.elements()), docs.schema), kept
    stored = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert stored.count() == sum(rows.values())


def test_stages_on_an_empty_table(spark, docs):
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).count() == 0, name
