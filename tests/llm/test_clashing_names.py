"""Columns named as the operators name their own, rows without ids, extreme turns."""

from pyspark.sql import functions as F

from churnloom.llm import chat, mixing, quality_classifier, simhash

NAMES = ["_source", "_count", "_order", "_copy", "_text", "_kept", "row", "key", "copy", "order", "th", "id", "piece", "of"]


def _table(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return docs.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce("text", F.lit("-"))).alias(n) for n in NAMES])


def test_names_of_inner_columns_are_free(spark):
    docs = _table(spark, [(i, f"text {i} of some words", f"s{i % 2}") for i in range(40)] + [(40, None, None)])
    for out in (mixing.mixed(docs, total=90), simhash.keep_one(docs)):
        rows = out.collect()
        assert out.columns == docs.columns and len(rows) > 20
        assert all(r[n] == f"{n}:{r.text or '-'}" for r in rows for n in NAMES)
    shuffled = mixing.shuffled(docs)
    assert sorted(shuffled.columns) == sorted(docs.columns)
    assert all(len(r._order) == 32 for r in shuffled.collect())


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    docs = _table(spark, [(None, f"text {i}", "s") for i in range(200)])
    for seed in range(6):
        rows = mixing.shuffled(docs, seed=seed).collect()
        assert 140 < len(rows) < 260 and 90 < len({r.text for r in rows}) < 160
        assert len({r._order for r in rows}) == len(rows)


def test_extreme_turns_keep_their_order(spark):
    turns = [2**63 - 1, 2**62 + 5, 0, -1, -(2**62) - 7, -(2**63) + 1]
    rows = [(1, t, "user", f"m{t}") for t in turns] + [(2, 2**63 - 1, "user", "> a\n> b\nyes"), (2, -(2**63) + 1, "bot", "a\nb")]
    got = {r.conv_id: r for r in chat.formatted(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert [line for line in got[1].chat.split("\n") if line.startswith("m")] == [f"m{t}" for t in sorted(turns)]
    assert got[2].n_quotes == got[2].n_linked > 0


def test_sample_is_the_same_under_any_partitioning(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id bigint, quality int")
    drawn = [
        sorted(r.id for r in quality_classifier.sample(labels.repartition(parts), rows=100).collect()) for parts in (1, 5, 30)
    ]
    assert drawn[0] == drawn[1] == drawn[2] and 60 < len(drawn[0]) <= 100
