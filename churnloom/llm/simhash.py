"""Near-duplicates by SimHash fingerprints and multi-index hashing.

Method: a fingerprint of 64 bits has three segments (21, 21 and 22 bits). Two
fingerprints that differ in at most two bits agree, for at least one segment, on the
two other segments up to one bit: if both differing bits lie in one segment, the rest is
equal; if they lie in two, leaving out the later one leaves one differing bit. So there
are three tables, each keyed by the fingerprint without one segment. Every fingerprint
is in each table once and looks up its own key, and the members of the Hamming ball of
radius one in the earlier segments. Of two keys that differ in one bit just one has that
bit set, so only set bits are cleared, which halves the ball. Matches of a table are
verified by the whole distance. Keys hold 42 bits or more: what shares one is nearly
always a link, and copies are no rows of their own, since tables hold each different
fingerprint once.

Defined results: null or empty text has fingerprint zero and is linked like any other;
null doc_id is never the smallest of a group that has another, a group without any gets
null; repeated rows are each returned; an empty table gives an empty table; other
columns are ignored by ``groups`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.llm.common import same, texts
from churnloom.llm.components import components
from churnloom.session import stored

WIDTH = 3
SEED = 42
#: First and last bit (exclusive) of each segment.
SEGMENTS = ((0, 21), (21, 42), (42, 64))
#: The method above is laid out for this distance.
DISTANCE = 2


def fingerprint(text: str, width: int = WIDTH) -> int:
    """Unsigned; a bit is one if it is set in over half the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII letters only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    last = (ends - 1).tolist()
    width = min(width, len(words))
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter(
        (hashed(joined[a:b], SEED) for a, b in zip(starts, last[width - 1 :])), np.uint64
    )
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 15):
        part = h[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(h))
    return int(np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64), initial=np.uint64(0)))


def fingerprints(docs: DataFrame, width: int = WIDTH, keyed: bool = False) -> DataFrame:
    """doc_id and fingerprint as a (signed) bigint, a row for each row; if ``keyed``, also
    th, the hash of the text, which with doc_id names a row of ``docs``."""
    kept = ["doc_id", "th"] if keyed else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), width) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(np.array(fps, np.uint64).view(np.int64))],
                names=[*kept, "fp"],
            )

    rows = texts(docs)
    if keyed:
        rows = rows.withColumn("th", F.xxhash64("text"))
    return rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in [*kept, "fp"]))


def _mask(segment: int) -> int:
    first, last = SEGMENTS[segment]
    mask = (1 << last) - (1 << first)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of different fingerprints at two or fewer bits; ``fps`` holds each
    fingerprint once, in column ``fp``."""
    tables = [
        F.struct(
            F.lit(j).alias("t"),
            F.col("fp").bitwiseAND(F.lit(~_mask(j))).alias("key"),
        )
        for j in range(len(SEGMENTS))
    ]
    index = fps.select("fp", F.explode(F.array(*tables)).alias("x")).select("x.t", "x.key", "fp")
    # A set bit of segment i, cleared, in every table that leaves out a later segment.
    bits = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS[1][1] - 1))).alias("bit"))
    bits = bits.where(F.expr("shiftright(fp, bit) & 1 = 1")).withColumn(
        "fewer", F.expr("fp & ~shiftleft(1L, bit)")
    )
    balls = None
    for j in (1, 2):
        part = bits.where(F.col("bit") < SEGMENTS[j][0]).select(
            F.lit(j).alias("t"), F.col("fewer").bitwiseAND(F.lit(~_mask(j))).alias("key"), "fp"
        )
        balls = part if balls is None else balls.union(part)
    probes = index.withColumn("own", F.lit(True)).union(balls.withColumn("own", F.lit(False)))
    p, q = probes.alias("p"), index.alias("q")
    near = (
        (F.col("p.t") == F.col("q.t"))
        & (F.col("p.key") == F.col("q.key"))
        & (F.bit_count(F.col("p.fp").bitwiseXOR(F.col("q.fp"))) <= DISTANCE)
        & (F.col("p.fp") != F.col("q.fp"))
        & (~F.col("p.own") | (F.col("p.fp") < F.col("q.fp")))
    )
    return (
        p.join(q, near)
        .select(F.least("p.fp", "q.fp").alias("a"), F.greatest("p.fp", "q.fp").alias("b"))
        .distinct()
    )


def groups(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id, a row for each row."""
    rows = stored(fingerprints(docs, width), "fingerprints")
    first = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    joined = stored(components(links(first.select("fp"))), "roots")
    # Only fingerprints with a link are in ``joined``.
    linked = stored(first.join(joined, F.col("fp") == F.col("node")).select("fp", "root", "first"), "linked")
    least = stored(linked.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    linked = linked.join(least, "root").select("fp", "component_id")
    alone = first.join(joined, F.col("fp") == F.col("node"), "left_anti").select(
        "fp", F.col("first").alias("component_id")
    )
    classes = stored(linked.union(alone), "classes")
    return rows.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row of ``docs`` of each group: the smallest doc_id (null last), of equal ones
    the smallest hash of the text."""
    rows = stored(fingerprints(docs, width, keyed=True), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th")
    first = stored(rows.groupBy("fp").agg(F.min(place).alias("first")), "firsts")
    joined = stored(components(links(first.select("fp"))), "roots")
    least = (
        first.join(joined, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("first").alias("first"))
    )
    kept = least.select(F.col("first.doc_id").alias("_kept"), F.col("first.th").alias("_kept_text"))
    kept = stored(kept, "kept")
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("bigint").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
    )
    match = same(keyed["id"], kept["_kept"]) & (keyed["th"] == kept["_kept_text"])
    return keyed.join(kept, match, "left_semi").dropDuplicates(["id", "th"]).select("row.*")
