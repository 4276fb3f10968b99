"""Near-duplicates by fast similarity sketching, banding and exact verification.

Method:

1. A document's set are its different runs of five words. Its sketch has ``BINS``
   coordinates, filled in rounds: in each of the first ``BINS`` rounds every element of
   the set is thrown into a bin by a hash of that round; in the rounds after, all elements
   go to one fixed bin. A coordinate is the least (round, hash) of what fell into its bin,
   and the rounds end when all bins are filled, so every coordinate of every set that is
   not empty is filled. Two sets agree in a coordinate with a probability that is their
   Jaccard similarity, and the share of equal coordinates is concentrated around it.
2. ``ROWS`` neighbouring coordinates are a band. Sets that agree on a band share a bucket:
   at a similarity of 0.85 they share none of the 30 with a probability of 2.3e-8.
3. A bucket of many sets is cut into blocks by hash, each two blocks are a tile. A tile
   first compares sketches: pairs that met in an earlier band, whose sizes exclude a link
   or whose sketches are too far apart (4.6 standard deviations below the bound) go. Only
   sets that are left with a partner get their shingles, and the tile verifies pairs on
   full sets, most similar ones first, leaving out pairs that it has already connected.
   What a tile returns is a forest, fewer links than it has sets.
4. Components of the verified links over different sets; copies are no rows of their own.

A tile holds at most two blocks of ``BLOCK`` sets or, with long texts, of ``BLOCK_SHINGLES``
shingles (or one longer set). Within a bucket the number of tiles grows with the square of
its sets divided by the block, which is the price of confirming every link; no pair is a row.

Defined results: null or blank text has an empty set, and its row is a component of its
own; null doc_id is never the smallest of a component that has another, a component
without any gets null and is not kept; repeated rows are each returned; an empty table
gives an empty table; columns other than doc_id and text are ignored. Shingles are
compared by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.llm.common import likely, mix, powers, same, texts
from churnloom.llm.components import components
from churnloom.session import stored

WIDTH = 5
#: A link: NEAR * size of the intersection >= ALIKE * size of the union.
NEAR, ALIKE = 100, 85
BINS, ROWS = 150, 5
BANDS = BINS // ROWS
#: Equal coordinates of a pair worth verifying; at a similarity of 0.85 the mean is 127.5
#: and the standard deviation 4.4.
LIKELY = 107
#: Sets, and shingles of all its sets, of a block.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000

_U64 = np.uint64
_SEED = 0x5851F42D4C957F2D


# --- sets and sketches -----------------------------------------------------------------
def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted different hashes of the runs of ``width`` words (fewer words: of them all)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII letters only
    if not words:
        return np.zeros(0, _U64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    last = (ends - 1).tolist()
    width = min(width, len(words))
    hashed = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((hashed(joined[a:b]) for a, b in zip(starts, last[width - 1 :])), _U64))


_KEYS = mix(powers(_SEED, 2 * BINS + 1)[1:])


def sketch(elements: np.ndarray) -> np.ndarray:
    """``BINS`` coordinates of a set that is not empty: the round in the upper byte and a
    half, the hash below."""
    out = np.full(BINS, np.iinfo(_U64).max, _U64)
    for i in range(2 * BINS):
        h = mix(elements ^ _KEYS[i])
        value = (_U64(i) << _U64(52)) | (h >> _U64(12))
        if i < BINS:
            # The bin comes from a second mixing, so that it does not order the values.
            at = ((mix(h) >> _U64(32)) * _U64(BINS)) >> _U64(32)
            open_ = out >= _U64(i) << _U64(52)
            use = open_[at]
            np.minimum.at(out, at[use], value[use])
        else:
            at = i - BINS
            if out[at] == np.iinfo(_U64).max:
                out[at] = value.min()
        if out.max() != np.iinfo(_U64).max:
            break
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    rows = mix(coordinates).reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=_U64)
    for j in range(ROWS):
        keys = mix(keys * _U64(0x9E3779B97F4A7C15) + rows[:, j])
    return keys


SKETCHED = "doc_id bigint, th bigint, high bigint, low bigint, n bigint, bands array<bigint>, sketch binary"


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and th (hash of the text) of each row; of its set a hash (high, low), the
    size, the keys of its bands and a byte of each coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named: list[tuple[int, int]] = []
            sizes, bands, bytes_ = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), width)
                sizes.append(len(found))
                whole = xxhash.xxh3_128_digest(found.astype("<u8").tobytes())
                named.append(tuple(np.frombuffer(whole, "<i8").tolist()))
                if len(found):
                    coordinates = sketch(found)
                    bands.append(band_keys(coordinates).view(np.int64))
                    bytes_.append((mix(coordinates) & _U64(255)).astype(np.uint8).tobytes())
                else:
                    bands.append(None)
                    bytes_.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("th"),
                    pa.array([a for a, _ in named], pa.int64()),
                    pa.array([b for _, b in named], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(bytes_, pa.binary()),
                ],
                names=["doc_id", "th", "high", "low", "n", "bands", "sketch"],
            )

    return texts(docs).withColumn("th", F.xxhash64("text")).mapInArrow(run, SKETCHED)


# --- tiles -----------------------------------------------------------------------------
def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of each tile, one after the other; the input is sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            here = tuple(c[a] for c in columns)
            if held and here != name:
                yield pa.Table.from_batches(held)
                held = []
            name = here
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


class Tile:
    """Sets of one bucket that stand in one or two of its blocks."""

    def __init__(self, rows: pa.Table) -> None:
        n = rows.num_rows
        self.sid = rows.column("sid").to_numpy()
        self.n = rows.column("n").to_numpy()
        self.block = rows.column("block").to_numpy()
        self.key = rows.column("key")[0].as_py()
        self.one = rows.column("lower")[0].as_py() == rows.column("upper")[0].as_py()
        self.bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(n, BANDS)
        self.sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(n, BINS)
        #: Where this bucket's band stands among the bands.
        self.band = int(np.flatnonzero(self.bands[0] == self.key)[0])

    def partners(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Later sets that may be linked with the i-th, and their equal coordinates."""
        rest = np.arange(i + 1, len(self.sid))
        if not self.one:
            rest = rest[self.block[rest] != self.block[i]]
        least, most = np.minimum(self.n[rest], self.n[i]), np.maximum(self.n[rest], self.n[i])
        rest = rest[NEAR * least >= ALIKE * most]
        if self.band and len(rest):
            met = (self.bands[rest, : self.band] == self.bands[i, : self.band]).any(axis=1)
            rest = rest[~met]
        equal = (self.sketch[rest] == self.sketch[i]).sum(axis=1)
        likely = equal >= LIKELY
        return rest[likely], equal[likely]


TILE = ["key", "lower", "upper"]
MEMBER = "key bigint, lower int, upper int, block int, sid bigint"


def _with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of tiles that are left with a partner after the sketches were compared."""
    for rows in _groups(batches, TILE):
        if rows.num_rows < 2:
            continue
        tile = Tile(rows)
        paired = np.zeros(rows.num_rows, bool)
        for i in range(rows.num_rows - 1):
            others, _ = tile.partners(i)
            if len(others):
                paired[i] = True
                paired[others] = True
        if paired.any():
            kept = rows.select([*TILE, "block", "sid"]).filter(pa.array(paired))
            yield from kept.combine_chunks().to_batches()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that connect what the verified pairs of each tile connect."""
    for rows in _groups(batches, TILE):
        tile = Tile(rows)
        sets: list[np.ndarray] = [np.frombuffer(x, "<u8") for x in rows.column("elements").to_pylist()]
        root = list(range(len(sets)))

        def find(x: int, root: list[int] = root) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        found = []
        pairs = [(i, *tile.partners(i)) for i in range(len(sets) - 1)]
        if not pairs:
            continue
        left = np.concatenate([np.full(len(o), i) for i, o, _ in pairs])
        right = np.concatenate([o for _, o, _ in pairs])
        for p in np.argsort(-np.concatenate([e for _, _, e in pairs]), kind="stable").tolist():
            i, j = int(left[p]), int(right[p])
            a, b = find(i), find(j)
            if a == b:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if NEAR * both >= ALIKE * (len(sets[i]) + len(sets[j]) - both):
                root[a] = b
                found.append((int(tile.sid[i]), int(tile.sid[j])))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"]
            )


def _members(classes: DataFrame, block: int, block_shingles: int) -> DataFrame:
    """A row for each set, bucket and tile (key, lower, upper); buckets of one set have none."""
    entries = classes.where("n > 0").select("sid", "n", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.count("*").alias("sets"), F.sum("n").alias("all_n"))
    buckets = stored(buckets.where("sets > 1"), "buckets")
    rows = entries.join(buckets, "key")
    blocks = F.ceil(F.greatest(F.col("sets") / block, F.col("all_n") / block_shingles)).cast("int")
    # More blocks than sets would only make empty ones.
    rows = rows.withColumn("blocks", F.least(blocks, F.col("sets").cast("int")))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("key", "block", "sid", other)
    return rows.select(
        "key", F.least("block", "other").alias("lower"), F.greatest("block", "other").alias("upper"), "block", "sid"
    )


def _by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition(*TILE).sortWithinPartitions(*TILE, "sid")


def _elements(docs: DataFrame, needed: DataFrame, width: int) -> DataFrame:
    """sid and elements of the sets of ``needed`` (sid, doc_id, th of a row that has it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), width).astype("<u8").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array(sets, pa.binary())], names=["sid", "elements"])

    rows = likely(texts(docs).withColumn("th", F.xxhash64("text")), "th", needed.select("th"))
    met = same(rows["doc_id"], needed["doc_id"]) & (rows["th"] == needed["th"])
    chosen = rows.join(needed, met).select("sid", "text").dropDuplicates(["sid"])
    return chosen.mapInArrow(run, "sid bigint, elements binary")


def links(
    docs: DataFrame, classes: DataFrame, width: int = WIDTH, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """Verified links (a, b) between different sets; they connect all that are linked.

    ``classes`` has a row for each set: sid, n, bands, sketch, and doc_id and th of a row
    of ``docs`` that has the set.
    """
    known = classes.select("sid", "n", "bands", "sketch")
    members = _members(classes, block, block_shingles)
    paired = _by_tile(members.join(known, "sid")).mapInArrow(_with_partners, MEMBER)
    paired = stored(paired, "paired")
    needed = classes.join(paired.select("sid").distinct(), "sid", "left_semi").select("sid", "doc_id", "th")
    elements = stored(_elements(docs, stored(needed, "needed"), width), "elements")
    rows = paired.join(elements.join(known, "sid"), "sid")
    return _by_tile(rows).mapInArrow(_verified, "a bigint, b bigint")


def groups(
    docs: DataFrame, width: int = WIDTH, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, a row for each row."""
    rows = stored(sketches(docs, width), "sketches")
    filled = rows.where("n > 0")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th")
    # Equal sets have equal sizes, bands and sketches.
    different = filled.groupBy("high", "low").agg(
        F.min(place).alias("row"), *[F.first(c).alias(c) for c in ("n", "bands", "sketch")]
    )
    classes = stored(
        different.select(
            F.monotonically_increasing_id().alias("sid"), "high", "low", "n", "bands", "sketch", "row.doc_id", "row.th"
        ),
        "classes",
    )
    found = stored(components(links(docs, classes, width, block, block_shingles)), "roots")
    firsts = classes.select("sid", "high", "low", F.col("doc_id").alias("first"))
    linked = stored(firsts.join(found, F.col("sid") == F.col("node")), "linked")
    least = stored(linked.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = linked.join(least, "root").select("high", "low", "component_id")
    alone = firsts.join(found, F.col("sid") == F.col("node"), "left_anti").select(
        "high", "low", F.col("first").alias("component_id")
    )
    known = stored(named.union(alone), "components")
    columns = [
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    ]
    empty = rows.where("n = 0").withColumn("component_id", F.col("doc_id"))
    return filled.join(known, ["high", "low"]).select(*columns).union(empty.select(*columns))
