"""Connected components of a graph that need not fit one machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.session import stored


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars that connect what the edges of a batch connect: fewer rows, same groups."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int, parent: dict[int, int] = parent) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        rows = [(x, r) for x in parent if (r := root(x)) != x]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], names=["u", "v"]
            )


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), "u").alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the least of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    others = edges.join(least, "u").where("v <> m")
    return others.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two bigint columns): the least node
    that can be reached. Loops and repeated edges change nothing.

    Large and small stars in turn until nothing changes (a number of rounds that
    grows with the logarithm of the graph); every round is a stored table, and the
    least neighbours are stored before they are joined, so that the rows of a node
    with very many neighbours can be split among tasks.
    """
    a, b = edges.columns
    ordered = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    # Stored first, so that a repeated task sees its edges in the same order.
    ordered = stored(ordered, "edges")
    stars = stored(ordered.mapInArrow(_forest, "u bigint, v bigint").distinct(), "stars")
    seen = None
    while True:
        state = stars.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen or not state[0]:
            break
        seen = state
        stars = stored(_large_star(stars).distinct(), "stars")
        stars = stored(_small_star(stars).distinct(), "stars")
    roots = stars.select("v").distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
