"""Merkle manifest against a plain version, for every shape of tree."""

import brute
import pytest
from conftest import bag

from churnloom.llm import merkle
from churnloom.session import scratch

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, n int, tree string, pos bigint"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "x", 5) for r in rows], SCHEMA).repartition(parts)


def got(spark, rows, levels=merkle.LEVELS):
    return bag(merkle.verified(spark, table(spark, rows), levels).collect())


@pytest.mark.parametrize("levels", [2, 5])
def test_all_sizes_of_trees(spark, levels):
    rows = [
        (1000 * n + i, f"s{i % 3}", f"l{n:02}", i if i % 5 else None, "é" * i)
        for n in (1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 33, 70)
        for i in range(n)
    ]
    assert got(spark, rows, levels) == bag(brute.merkle(rows))


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, "s", "de", 3, ""), (None, "s", "de", 3, ""), (None, "s", "de", 4, "x"),
        (7, "s", "de", 2**63 - 2, "a:b-"), (7, "s", "de", 1, "a"), (7, "s", "de", 1, "a"), (0, "", "", 0, ""),
        (-3, "日本", "日", 5, "🙂" * 50_000), (9, "s", "z", 1, "t"), (2**62, "s", "Z", 1, "t"),
    ]
    assert got(spark, rows) == bag(brute.merkle(rows))
    assert got(spark, rows[:1]) == bag(brute.merkle(rows[:1]))


def test_empty(spark):
    assert got(spark, []) == []


def test_one_language_holds_most(spark):
    rows = [(i, "s", "en" if i % 9 else None, i, f"t{i % 4}") for i in range(3000)]
    found = got(spark, rows)
    assert found == bag(brute.merkle(rows))
    assert not all(r[-1] for r in found)


def test_proofs_of_some_rows(spark):
    rows = [(i, "s", f"l{i % 3}", i, f"t{i}") for i in range(500)]
    manifest = merkle.Manifest(table(spark, rows), scratch(spark, "manifest"), 2)
    wanted = spark.createDataFrame([(5,), (77,), (9999,)], "doc_id bigint")
    some = {r.doc_id: r for r in manifest.proofs(wanted).collect()}
    every = {r.doc_id: r for r in manifest.proofs().collect()}
    assert {5, 77} <= set(some) and len(some) <= 8
    assert all(every[d] == r for d, r in some.items())
    assert manifest.root().collect()[0].root == every[5].root
