"""Manifest of a table as a Merkle tree, with proofs by checkpoint and recompute.

A leaf is the hash of a row's fields. The leaves of a tree (one for each language)
ascend by doc_id and are paired level by level; the roots of the trees are the leaves of
a last tree over all languages. Method:

1. Rows are placed by a range-partitioned sort: the place in a tree is the place in its
   range and the number of the tree's rows in the ranges before.
2. Only every ``LEVELS``-th level is stored. A row of a stored level holds an aligned
   subtree: the up to 2**LEVELS nodes that share their ancestor ``LEVELS`` levels up.
   The levels between are hashed on the way up and thrown away.
3. Proofs go down the stored levels: a subtree's missing interior nodes are computed
   again from its stored descendants, each node below gets the siblings on its way to the
   top of the subtree, put before those of the top itself, and the interior is dropped.

What is sent along is one list of siblings for each stored subtree, a ``2**LEVELS``-th of
the rows; a task holds one subtree at a time. All hashing is done by built-in functions.

Defined results: a null field is ``-``, an empty text ``0:``; null doc_id comes first and
is never tampered with; an n_chars that has no successor is tampered into null; null lang is a tree of its own, the first; equal doc_ids are
ordered by their leaf, so repeated rows stand side by side, a row each; an empty table
gives an empty table; columns other than the five hashed ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnloom.llm.common import same
from churnloom.session import scratch, stored

#: The hashed fields, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels between two stored ones; a stored row holds up to 2**LEVELS nodes.
LEVELS = 5
#: A row is tampered with where this divides the CRC-32 of its decimal doc_id.
TAMPERED_EVERY = 7

#: A step of a proof: a sibling's digest after the side it stands on; empty without one.
LEFT, RIGHT = "<", ">"


# --- hashes ----------------------------------------------------------------------------
def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    return _digest(F.concat(*[_field(columns[c]) for c in FIELDS]))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf and ``given``: the leaf of the row as it is presented for
    verification, null if it is the same."""
    columns = {c: F.col(c) for c in FIELDS}
    columns["doc_id"] = F.col("doc_id").cast("bigint")
    columns["n_chars"] = F.col("n_chars").cast("bigint")
    changed = columns | {"n_chars": F.expr("try_add(cast(n_chars AS bigint), 1L)")}
    hit = F.crc32(columns["doc_id"].cast("string")) % TAMPERED_EVERY == 0
    return docs.select(
        columns["doc_id"].alias("doc_id"),
        F.col("lang").cast("string").alias("tree"),
        F.unhex(leaf_hash(columns)).alias("leaf"),
        F.when(hit & F.col("n_chars").isNotNull(), F.unhex(leaf_hash(changed))).alias("given"),
    )


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


# --- places ----------------------------------------------------------------------------
def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the place in the node's tree, and ``n``, the tree's number of nodes.

    ``_at`` numbers the sorted rows of a partition one by one and is written with them;
    ``_copy`` makes equal rows differ, so that no value is too frequent for one range.
    """
    numbered = stored(nodes.withColumn("_copy", F.monotonically_increasing_id()), "nodes")
    keys = ["tree", *order, "_copy"]
    ranged = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_copy")
    rows = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("_range", F.shiftright("_at", 33))
    # One row for each tree and range: what is kept in a window is ranges, not rows.
    parts = rows.groupBy("tree", "_range").agg(F.min("_at").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("tree").alias("_tree"),
        F.col("_range").alias("_part"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    # Stored, so that its size decides how it is joined.
    offsets = stored(offsets, "offsets")
    met = same(rows["tree"], offsets["_tree"]) & (rows["_range"] == offsets["_part"])
    placed = rows.join(offsets, met).withColumn("pos", F.col("_at") + F.col("_shift"))
    return placed.drop("_at", "_range", "_tree", "_part", "_shift")


def _height() -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)


# --- subtrees --------------------------------------------------------------------------
def _up(level: Column) -> Column:
    """Digests of every two neighbours; the last one may be alone."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
    return F.transform(
        pairs,
        lambda i: F.unhex(
            _digest(F.concat(_hex(F.get(level, 2 * i)), F.coalesce(_hex(F.get(level, 2 * i + 1)), F.lit(""))))
        ),
    )


def _interior(nodes: Column, steps: Column) -> Column:
    """The subtree's levels from its stored nodes to its top."""
    bottom = F.transform(nodes, lambda x: x["digest"])
    rounds = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(
        rounds, F.array(bottom), lambda found, _: F.concat(found, F.array(_up(F.element_at(found, -1))))
    )


def _siblings(interior: Column, steps: Column, place: Column) -> Column:
    """Steps of the proof of the node at ``place``, up to the subtree's top."""

    def step(level: Column, up: Column) -> Column:
        at = F.call_function("shiftright", place, up)
        other = F.get(level, at.bitwiseXOR(F.lit(1)))
        side = F.when(at % 2 == 1, F.lit(LEFT)).otherwise(F.lit(RIGHT))
        return F.coalesce(F.concat(side, _hex(other)), F.lit(""))

    return F.transform(F.slice(interior, F.lit(1), steps), step)


class Forest:
    """Trees over placed nodes, of which every ``levels``-th level is stored."""

    def __init__(self, placed: DataFrame, folder: str, levels: int = LEVELS) -> None:
        """``placed`` has tree, pos, n, digest and ``payload``, a struct."""
        self.spark, self.folder, self.levels = placed.sparkSession, folder, levels
        self.heights = 0
        nodes = placed
        while True:
            self._store(nodes, self.heights)
            self.heights += 1
            nodes = self._tops(self.heights - 1).where(F.col("above") > levels)
            nodes = nodes.select("tree", F.col("block").alias("pos"), "n", "digest")
            if nodes.isEmpty():
                break

    def _store(self, nodes: DataFrame, k: int) -> None:
        kept = [c for c in ("pos", "digest", "payload") if c in nodes.columns]
        blocks = nodes.groupBy(
            "tree", F.shiftright("pos", self.levels).alias("block")
        ).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct(*kept))).alias("nodes"))
        blocks.write.parquet(f"{self.folder}/stored={k}")

    def blocks(self, k: int) -> DataFrame:
        """Stored subtrees: tree, block, n, nodes, ``above`` (levels from the stored nodes
        to the root) and ``steps`` (levels to the top of the subtree)."""
        rows = self.spark.read.parquet(f"{self.folder}/stored={k}")
        rows = rows.withColumn("above", F.greatest(_height() - k * self.levels, F.lit(0)))
        return rows.withColumn("steps", F.least("above", F.lit(self.levels)))

    def _tops(self, k: int) -> DataFrame:
        top = F.element_at(F.element_at(_interior(F.col("nodes"), F.col("steps")), -1), 1)
        return self.blocks(k).withColumn("digest", top)

    def roots(self) -> DataFrame:
        """tree, n and digest of each tree."""
        tops = None
        for k in range(self.heights):
            found = self._tops(k).where(F.col("above") <= self.levels).select("tree", "n", "digest")
            tops = found if tops is None else tops.union(found)
        return tops

    def proofs(self, trees: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
        """The payload of every leaf with ``path``, its proof, and what ``trees`` has.

        ``trees`` holds tree, n, ``path`` (steps above the tree's root, in a further
        tree) and any other columns. With ``wanted`` (tree, pos of a leaf) only their
        subtrees are read; the proofs are those of all leaves of these subtrees.
        """
        asked = [wanted]
        for _ in range(self.heights):
            below = asked[-1]
            if below is not None:
                below = below.select("tree", F.shiftright("pos", self.levels).alias("pos")).distinct()
                below = stored(below, "asked")
            asked.append(below)
        others = [c for c in trees.columns if c not in ("tree", "n", "path")]
        over = F.floor((_height() + self.levels - 1) / self.levels).cast("int") - 1
        trees = trees.withColumn("_k", F.greatest(over, F.lit(0)))
        known = None
        for k in reversed(range(self.heights)):
            mine = trees.where(F.col("_k") == k).select(
                "tree", F.lit(0).cast("bigint").alias("pos"), "path", *others
            )
            known = mine if known is None else known.union(mine)
            known = stored(known, "paths")
            blocks = self.blocks(k)
            if asked[k + 1] is not None:
                need = asked[k + 1]
                met = same(blocks["tree"], need["tree"]) & (blocks["block"] == need["pos"])
                blocks = blocks.join(need, met, "left_semi")
            met = same(blocks["tree"], known["tree"]) & (blocks["block"] == known["pos"])
            found = blocks.join(known.select("tree", "pos", "path", *others), met)
            found = found.select(blocks["tree"], "nodes", "steps", "path", *others)
            found = found.withColumn("_in", _interior(F.col("nodes"), F.col("steps")))
            each = F.transform(
                F.col("nodes"),
                lambda x, i: F.struct(
                    x.alias("node"),
                    F.concat(_siblings(F.col("_in"), F.col("steps"), i), F.col("path")).alias("path"),
                ),
            )
            found = found.select("tree", F.explode(each).alias("x"), *others)
            if k == 0:
                return found.select("tree", "x.node.payload.*", "x.node.digest", "x.path", *others)
            known = found.select("tree", F.col("x.node.pos").alias("pos"), "x.path", *others)
        raise AssertionError("a forest has a stored level")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf (hexadecimal) and its proof lead to."""

    def step(digest: Column, one: Column) -> Column:
        sibling = F.substring(one, 2, 64)
        ahead = F.startswith(one, F.lit(LEFT))
        return _digest(F.when(ahead, F.concat(sibling, digest)).otherwise(F.concat(digest, sibling)))

    return F.aggregate(path, start, step)


class Manifest:
    """A table's manifest in a folder: the trees' stored levels and the tree over them."""

    def __init__(self, docs: DataFrame, folder: str, levels: int = LEVELS) -> None:
        placed = _placed(leaves(docs), ["doc_id", "leaf"])
        rows = placed.select(
            "tree", "pos", "n", F.col("leaf").alias("digest"), F.struct("doc_id", "given").alias("payload")
        )
        self.rows = Forest(rows, f"{folder}/rows", levels)
        self.subroots = stored(self.rows.roots(), "subroots")
        tops = self.subroots.select(
            F.lit("").alias("tree"), F.col("tree").alias("lang"), F.col("digest").alias("leaf"), "n"
        )
        tops = _placed(tops.withColumnRenamed("n", "rows"), ["lang"])
        tops = tops.select(
            "tree", "pos", "n", F.col("leaf").alias("digest"), F.struct("lang", "rows").alias("payload")
        )
        self.tops = Forest(tops, f"{folder}/tops", levels)

    def root(self) -> DataFrame:
        """One row with the root and the number of trees; none for an empty table."""
        return self.tops.roots().select(_hex(F.col("digest")).alias("root"), F.col("n").alias("trees"))

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """doc_id, lang, leaf, given, subroot, root and path (steps) of every row; of the
        rows in the subtrees that hold the doc_ids of ``wanted`` if it is given."""
        top = self.tops.roots().withColumn("path", F.array().cast("array<string>"))
        top = top.select("tree", "n", "path", _hex(F.col("digest")).alias("root"))
        trees = self.tops.proofs(top).select(
            F.col("lang").alias("tree"),
            F.col("rows").alias("n"),
            "path",
            _hex(F.col("digest")).alias("subroot"),
            "root",
        )
        places = None
        if wanted is not None:
            flat = self.rows.blocks(0).select("tree", F.explode("nodes").alias("x"))
            ids = wanted.select(F.col("doc_id").cast("bigint").alias("_id")).distinct()
            hit = flat.join(ids, same(flat["x.payload.doc_id"], F.col("_id")), "left_semi")
            places = hit.select("tree", "x.pos")
        found = self.rows.proofs(trees, places)
        return found.select(
            "doc_id",
            F.col("tree").alias("lang"),
            _hex(F.col("digest")).alias("leaf"),
            _hex(F.coalesce("given", "digest")).alias("given"),
            "subroot",
            "root",
            "path",
        )


def verified(spark: SparkSession, docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The digest of every row's proof, and whether what is presented leads to the root."""
    proofs = Manifest(docs, scratch(spark, "manifest"), levels).proofs()
    siblings = F.array_join(F.transform("path", lambda p: F.substring(p, 2, 64)), "")
    folded = proofs.withColumn("proof_sha256", _digest(siblings)).withColumn(
        "folded_root", fold(F.col("given"), F.col("path"))
    )
    return folded.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
