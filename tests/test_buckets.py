"""Newest rows in hash buckets: versions, retries, clean-up, pruned reads."""

import pytest
from pyspark.sql import functions as F

from churnloom import __main__ as commands
from churnloom import schemas
from churnloom.sources import files, tables
from churnloom.sources.buckets import BucketTable

SCHEMA = schemas.columns("msno string, at bigint, v string")


def rows(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def content(table, version=None):
    return sorted(tuple(r) for r in table.read(version).collect())


@pytest.fixture
def table(spark, tmp_path):
    return BucketTable(spark, str(tmp_path / "t"), SCHEMA, "at", buckets=8)


def test_newest_row_wins_in_any_order(spark, table):
    table.write(rows(spark, [("a", 1, "x"), ("b", 5, "y"), ("a", 3, "z")]), 1)
    table.write(rows(spark, [("b", 2, "old"), ("c", 1, "new"), ("a", 4, "w")]), 2, 1)
    assert content(table) == [("a", 4, "w"), ("b", 5, "y"), ("c", 1, "new")]
    assert content(table, 1) == [("a", 3, "z"), ("b", 5, "y")]


def test_a_version_written_again_replaces_its_first_try(spark, table):
    table.write(rows(spark, [("a", 1, "x")]), 1)
    table.write(rows(spark, [(f"u{i}", 1, "lost") for i in range(30)]), 2, 1)
    table.write(rows(spark, [("a", 2, "y")]), 2, 1)
    assert content(table) == [("a", 2, "y")]


def test_version_without_manifest_does_not_exist(spark, table):
    table.write(rows(spark, [("a", 1, "x")]), 1)
    table.write(rows(spark, [("a", 2, "y")]), 2, 1)
    files.remove(spark, f"{table.root}/manifest/version=2/_SUCCESS")
    assert table.versions() == [1] and content(table) == [("a", 1, "x")]


def test_empty(spark, table):
    assert content(table) == []
    table.write(rows(spark, []), 1)
    assert content(table) == [] and table.read(keys=rows(spark, [("a", 1, "x")])).count() == 0
    table.write(rows(spark, [("a", 1, None), (None, 1, "n")]), 2, 1)
    assert table.read().count() == 2


def test_clean_keeps_what_is_pointed_to(spark, table):
    table.write(rows(spark, [(f"u{i}", 1, "x") for i in range(100)]), 1)
    for v in range(2, 7):
        table.write(rows(spark, [("u1", v, "y")]), v, v - 1)
    table.clean(keep=2)
    assert table.versions() == [5, 6]
    held = files.partition_values(spark, f"{table.root}/rows", "version")
    assert sorted(held) == ["1", "5", "6"]
    assert table.read().count() == 100 and table.read().agg(F.max("at")).first()[0] == 6
    assert len(files.partition_values(spark, f"{table.root}/rows/version=1", "bucket")) == 7


def test_lookup_reads_the_buckets_of_its_keys(spark, table):
    table.write(rows(spark, [(f"u{i}", 1, "x") for i in range(200)]), 1)
    keys = spark.createDataFrame([("u5",), ("u5",), ("nobody",)], "msno string")
    found = table.read(keys=keys)
    assert len(found.inputFiles()) <= 2 < len(table.read().inputFiles())
    assert found.where("msno = 'u5'").count() == 1


def test_number_of_buckets_is_that_of_the_first_write(spark, table, tmp_path):
    table.write(rows(spark, [(f"u{i}", 1, "x") for i in range(50)]), 1)
    other = BucketTable(spark, table.root, SCHEMA, "at", buckets=3)
    other.write(rows(spark, [("u1", 2, "y")]), 2, 1)
    assert other.buckets == 8 and other.read().count() == 50


def test_materialize_command(spark, tmp_path):
    from churnloom.plans.workspace import Workspace

    w = Workspace(spark, "/root/testdata/sf0.001")
    features, out = str(tmp_path / "features"), str(tmp_path / "latest")
    tables.append_features(w.cumulative().drop("day"), features)
    for extra in ([], ["--since", "2024-01-28"]):
        commands.main(["materialize", "--features", features, "--out", out, "--buckets", "4", *extra])
    table = commands._bucketed(spark, out)
    assert table.versions() == [1, 2]
    want = w.latest()
    got = table.read().select(*want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_files_with_other_headers(spark, tmp_path):
    texts = {
        "a/one.csv": "msno,is_churn\nx,1\ny,0\n",
        "a/two.csv": "﻿Is_Churn, MSNO,extra\n1,z,e\nno,w,f\n",
        "b/three of them+%.csv": "msno,is_churn\nq,\n",
    }
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    read = tables.read_bronze(spark, [str(tmp_path / "a"), str(tmp_path / "b")], "train", count_bad=True)
    got = {r.msno: (r.is_churn, r.extra, r[tables.UNPARSABLE]) for r in read.collect()}
    assert got == {
        "x": (1, None, []), "y": (0, None, []), "z": (1, "e", []), "w": (None, "f", ["is_churn"]), "q": (None, None, []),
    }
    assert [tuple(r) for r in tables.unparsable(read).collect()] == [("is_churn", 1)]


def test_rows_without_a_score_say_nothing(spark):
    from churnloom.operators import evaluation

    scored = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, None), (0, float("nan")), (None, 0.5)], "is_churn int, score double")
    counts = evaluation.threshold_counts(scored)
    assert counts.count() == 2 and evaluation.auc(counts).first().auc_roc == 1.0
