"""Hard negatives by exact integer scores, behind angular triangle bounds.

A row's components are floor(256 * x); a score is the integer inner product. An anchor's
positives are its best rows of the same label, its hard negatives the best rows of other
labels whose score lies in a window below a positive's. Method:

1. A few reference directions are fitted on a bounded sample (spherical k-means); every
   row stores its angles to them and its norm.
2. For two rows and a reference, the angle between the rows is at least the difference of
   their angles and at most their sum (or 2 pi less their sum). Over all references this
   gives an interval of the cosine; times both norms, widened by more than all rounding,
   an interval that surely holds the integer score.
3. Rows lie in blocks of one label. Where all of a block's angles and norms cannot reach
   any window of a block of anchors, the two blocks never meet. In a meeting, a row is
   scored only if its interval overlaps a window and reaches the best lower bounds that
   surely lie in it; the integer score then decides.

Anchors are a stated query set against all rows, in blocks: a meeting holds one block of
anchors and one of rows and returns the few best rows of each anchor, and windows over
those with a limit before the shuffle pick the best of all meetings.

Defined results: rows with a null label, a null vector or any null or non-finite component
take no part, nor do rows with a squared norm of 2**62 or more, whose scores may leave 64
bits; a null vec_id is no anchor, keeps its label and comes last among ties; shorter
vectors are filled up with zeros; an empty vector scores 0; repeated rows are rows of
their own, and a repeated anchor lists its results again; an empty table, or one without
anchors, gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnloom.session import stored

#: Anchors are rows whose vec_id this divides.
ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is at least LOW and at most HIGH hundredths of the positive's.
LOW, HIGH = 50, 95
REFERENCES = 8
#: Rows the references are fitted on, at most.
FITTED_ROWS = 2_000
#: Anchors and rows of a block.
ANCHOR_BLOCK, ROW_BLOCK = 1_024, 4_096
#: Anchors that are bounded at a time; it sets memory, not results.
SLAB = 32

#: Radians by which intervals of angles are widened; the arc cosine loses half the digits
#: near its ends, 4.5e-8 at most.
ANGLE_MARGIN = 1e-6
#: Relative and absolute widening of scores.
SCORE_MARGIN = 1e-9


# --- rows ------------------------------------------------------------------------------
def prepared(embeddings: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, label and v (whole numbers as doubles) of the rows
    that take part."""
    vec_id, label = F.col("vec_id").cast("bigint"), F.col("label").cast("bigint")
    v = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    moved = F.when(F.coalesce(vec_id % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    # A component this large fails the bound below; floor() of it would not fit.
    small = F.forall("embedding", lambda x: F.abs(x.cast("double")) < float(2**24))
    rows = rows.where(small).select(vec_id.alias("vec_id"), moved.alias("label"), v.alias("v"))
    rows = rows.where(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x) < float(2**62))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def fit_references(rows: DataFrame, n: int = REFERENCES, limit: int = FITTED_ROWS) -> np.ndarray:
    """Unit vectors, a row each: centres of a hashed sample of at most ``limit`` rows."""
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    drawn = rows.select("v").orderBy(F.xxhash64("v"), "v").limit(limit).collect()
    x = _matrix([r.v for r in drawn], width)
    norms = np.linalg.norm(x, axis=1)
    x = x[norms > 0] / norms[norms > 0, None]
    if not len(x):
        return np.zeros((0, width))
    centres = x[:n].copy()
    for _ in range(10):
        nearest = np.argmax(x @ centres.T, axis=1)
        for k in range(len(centres)):
            mean = x[nearest == k].sum(axis=0)
            if np.linalg.norm(mean) > 0:
                centres[k] = mean / np.linalg.norm(mean)
    return centres


def angles_to(v: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of rows to the references; of a zero vector a right angle."""
    cosines = (v @ references.T) / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0))


# --- blocks ----------------------------------------------------------------------------
PLACED = "row bigint, vec_id bigint, label bigint, v array<double>, cone bigint, spread bigint"
PACKED = pa.schema(
    [
        ("number", pa.int64()), ("label", pa.int64()), ("n", pa.int32()),
        *[(c, pa.binary()) for c in ("rows", "ids", "named", "norms", "angles", "v")],
        ("least", pa.list_(pa.float64())), ("most", pa.list_(pa.float64())),
    ]
)
BLOCK = (
    "number bigint, label bigint, n int, rows binary, ids binary, named binary, norms binary,"
    " angles binary, v binary, least array<double>, most array<double>"
)


def placed(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """Rows with their nearest reference, ``cone``, and ``spread``, a hash of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v").to_pylist(), references.shape[1])
            near = np.argmax(v @ references.T, axis=1) if len(references) else np.zeros(len(v))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("row", "vec_id", "label", "v")],
                    pa.array(near.astype(np.int64), pa.int64()),
                    batch.column("spread"),
                ],
                names=["row", "vec_id", "label", "v", "cone", "spread"],
            )

    named = rows.withColumn("spread", F.xxhash64("row"))
    return stored(named.mapInArrow(run, PLACED), "placed")


def blocks(rows: DataFrame, references: np.ndarray, size: int) -> DataFrame:
    """Placed rows packed by label, about ``size`` in a block; a row of the result is a
    block. A label of more rows is cut by the nearest reference, so that the angles of a
    block lie close together, and then by hash."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        v = _matrix(table.column("v").to_pylist(), references.shape[1])
        ids = table.column("vec_id")
        norms = np.sqrt((v * v).sum(axis=1))
        angles = angles_to(v, norms, references)
        bounds = np.column_stack([norms, angles])
        block = {
            "number": 0, "label": key[0].as_py(), "n": len(v),
            "rows": table.column("row").to_numpy().tobytes(),
            "ids": ids.fill_null(0).to_numpy().tobytes(),
            "named": ids.is_valid().to_numpy().astype(np.uint8).tobytes(),
            "norms": norms.tobytes(), "angles": angles.tobytes(), "v": v.tobytes(),
            "least": bounds.min(axis=0).tolist(), "most": bounds.max(axis=0).tolist(),
        }
        return pa.Table.from_pylist([block], schema=PACKED)

    cut = rows.groupBy("label").agg((F.count("*") > size).alias("cut"))
    rows = rows.join(stored(cut, "labels"), "label")
    rows = rows.withColumn("cone", F.when(F.col("cut"), F.col("cone")).otherwise(F.lit(-1)))
    counts = rows.groupBy("label", "cone").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    dealt = rows.join(stored(counts, "counts"), ["label", "cone"])
    dealt = dealt.withColumn("part", F.pmod("spread", "parts").cast("int")).drop("cut", "parts", "spread")
    found = dealt.groupBy("label", "cone", "part").applyInArrow(pack, BLOCK)
    return stored(found.withColumn("number", F.monotonically_increasing_id()), "blocks")


class Block:
    """A packed block in NumPy."""

    def __init__(self, x: dict, width: int, references: int) -> None:
        n = x["n"]
        self.number, self.label = x["number"], x["label"]
        self.rows = np.frombuffer(x["rows"], "<i8")
        self.ids = np.frombuffer(x["ids"], "<i8")
        self.named = np.frombuffer(x["named"], np.uint8).astype(bool)
        self.norms = np.frombuffer(x["norms"], np.float64)
        self.angles = np.frombuffer(x["angles"], np.float64).reshape(n, references)
        self.v = np.frombuffer(x["v"], np.float64).reshape(n, width)


def intervals(
    low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of rows whose norm (first column) and angles lie between
    low and high; the arrays are broadcast against each other, the last axis are columns."""
    shape = np.broadcast_shapes(low_a.shape, low_b.shape)[:-1]
    least, most = np.zeros(shape), np.full(shape, np.pi)
    for j in range(1, low_a.shape[-1]):
        la, ha, lb, hb = low_a[..., j], high_a[..., j], low_b[..., j], high_b[..., j]
        np.maximum(least, la - hb, out=least)
        np.maximum(least, lb - ha, out=least)
        np.minimum(most, ha + hb, out=most)
        np.minimum(most, 2 * np.pi - (la + lb), out=most)
    top = np.cos(np.maximum(least - ANGLE_MARGIN, 0.0))
    bottom = np.cos(np.minimum(most + ANGLE_MARGIN, np.pi))
    longest, shortest = high_a[..., 0] * high_b[..., 0], low_a[..., 0] * low_b[..., 0]
    margin = 1.0 + SCORE_MARGIN * longest
    return (
        np.where(bottom >= 0, bottom * shortest, bottom * longest) - margin,
        np.where(top >= 0, top * longest, top * shortest) + margin,
    )


def _scores(a: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: as doubles while every partial sum is below
    2**53, as integers modulo 2**64 beyond (a score itself is below 2**62)."""
    if np.sqrt((a * a).sum()) * np.sqrt((rows * rows).sum(axis=1).max(initial=0.0)) < 2.0**52:
        return (rows @ a).astype(np.int64)
    return (rows.astype(np.int64) * a.astype(np.int64)).sum(axis=1, dtype=np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, named: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` best: higher scores, then smaller ids, those without an id last."""
    if len(scores) > 4 * n:
        bound = np.partition(scores, len(scores) - n)[len(scores) - n]
        keep = np.flatnonzero(scores >= bound)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], ~named[keep], -scores[keep]))[:n]]


def _columns(block: Block) -> np.ndarray:
    return np.column_stack([block.norms, block.angles])


def best_alike(anchors: Block, rows: Block, n: int) -> Iterator[tuple[int, int, int, bool]]:
    """(place of the anchor, score, id, named) of the ``n`` best other rows of each anchor.

    A row whose greatest score is below the n-th of the others' least scores is not among them.
    """
    mine, theirs = _columns(anchors), _columns(rows)
    for first in range(0, len(mine), SLAB):
        slab = mine[first : first + SLAB, None, :]
        least, most = intervals(slab, slab, theirs[None], theirs[None])
        for k in range(len(slab)):
            others = np.flatnonzero(rows.rows != anchors.rows[first + k])
            low = least[k, others]
            if len(others) > n:
                others = others[most[k, others] >= np.partition(low, len(low) - n)[len(low) - n]]
            scores = _scores(anchors.v[first + k], rows.v[others])
            for c in _best(scores, rows.ids[others], rows.named[others], n).tolist():
                at = others[c]
                yield first + k, int(scores[c]), int(rows.ids[at]), bool(rows.named[at])


def best_in_windows(
    anchors: Block, windows: list[list[tuple[int, int]]], rows: Block, n: int
) -> Iterator[tuple[int, int, int, int, bool]]:
    """(place of the anchor, number of its window, score, id, named) of the ``n`` best
    rows of each window (least, greatest score)."""
    mine, theirs = _columns(anchors), _columns(rows)
    for first in range(0, len(mine), SLAB):
        slab = mine[first : first + SLAB, None, :]
        least, most = intervals(slab, slab, theirs[None], theirs[None])
        for k in range(len(slab)):
            wanted = np.zeros(least.shape[1], bool)
            for low, high in windows[first + k]:
                if low > high:
                    continue
                fit = (most[k] >= low) & (least[k] <= high)
                surely = least[k][(least[k] >= low) & (most[k] <= high)]
                if len(surely) >= n:
                    fit &= most[k] >= np.partition(surely, len(surely) - n)[len(surely) - n]
                wanted |= fit
            fit = np.flatnonzero(wanted)
            if not len(fit):
                continue
            scores = _scores(anchors.v[first + k], rows.v[fit])
            for w, (low, high) in enumerate(windows[first + k]):
                inside = np.flatnonzero((scores >= low) & (scores <= high))
                at = fit[inside]
                for c in _best(scores[inside], rows.ids[at], rows.named[at], n).tolist():
                    yield first + k, w, int(scores[inside[c]]), int(rows.ids[at[c]]), bool(rows.named[at[c]])


# --- meetings --------------------------------------------------------------------------
ALIKE = "number bigint, place int, anchor_id bigint, score bigint, id bigint"
INSIDE = "number bigint, place int, window int, score bigint, id bigint"


def _payload(side: str, *more: str) -> list:
    fields = ["number", "label", "n", "rows", "ids", "named", "norms", "angles", "v", *more]
    return [F.col(f"{side}.{c}").alias(f"{side}_{c}") for c in fields]


def _met(tiles: DataFrame, anchors: DataFrame, rows: DataFrame, *more: str) -> DataFrame:
    """Meetings (a, r) with their two blocks; the smaller blocks, of anchors, travel."""
    a = tiles.join(anchors.alias("a"), F.col("a") == F.col("a.number")).select("r", *_payload("a", *more))
    return a.join(rows.alias("r"), F.col("r") == F.col("r.number")).select(
        *[c for c in a.columns if c != "r"], *_payload("r")
    )


def _sides(batch: pa.RecordBatch, width: int, refs: int) -> Iterator[tuple[Block, Block, dict]]:
    for i in range(batch.num_rows):
        x = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
        sides = [Block({k[2:]: v for k, v in x.items() if k.startswith(s)}, width, refs) for s in ("a_", "r_")]
        yield *sides, x


def _table(found: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def positives_of(anchors: DataFrame, rows: DataFrame, width: int, refs: int, n: int) -> DataFrame:
    """number, place and anchor_id of each anchor, ``window`` (from 0), positive_id and
    positive_score of its ``n`` best rows of the same label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mine, theirs, _ in _sides(batch, width, refs):
                found = [
                    (mine.number, place, int(mine.ids[place]), score, vec_id if named else None)
                    for place, score, vec_id, named in best_alike(mine, theirs, n)
                ]
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield _table(found, ["number", "place", "anchor_id", "score", "id"], types)

    # Blocks of one label meet; the numbers of blocks are all that this join holds.
    tiles = anchors.select(F.col("number").alias("a"), "label").join(
        rows.select(F.col("number").alias("r"), "label"), "label"
    )
    found = _met(tiles.select("a", "r"), anchors, rows).mapInArrow(run, ALIKE)
    best = Window.partitionBy("number", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("window", F.row_number().over(best)).where(F.col("window") <= n)
    return ranked.select(
        "number", "place", "anchor_id", (F.col("window") - 1).alias("window"),
        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
    )


def bounds_of(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _tiles(anchors: DataFrame, rows: DataFrame, group: int = 1_000) -> DataFrame:
    """Numbers (a, r) of blocks of other labels whose scores can reach a window.

    Blocks' numbers and bounds meet in groups of about ``group`` blocks of anchors.
    """
    groups = anchors.count() // group + 1
    a = anchors.select(
        F.pmod(F.xxhash64("number"), F.lit(groups)).alias("g"), F.col("number").alias("a"),
        F.col("label").alias("a_label"), F.col("least").alias("a_least"), F.col("most").alias("a_most"), "low", "high",
    )
    r = rows.select(
        F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("g"), F.col("number").alias("r"),
        F.col("label").alias("r_label"), F.col("least").alias("r_least"), F.col("most").alias("r_most"),
    )

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [
                batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1)
                for c in ("a_least", "a_most", "r_least", "r_most")
            ]
            least, most = intervals(*sides)
            low, high = batch.column("low").to_numpy(), batch.column("high").to_numpy()
            kept = pa.array((most >= low) & (least <= high))
            yield batch.select(["a", "r"]).filter(kept)

    pairs = a.join(r, "g").where("a_label <> r_label")
    pairs = pairs.select("a", "r", "a_least", "a_most", "r_least", "r_most", "low", "high")
    return pairs.mapInArrow(reach, "a bigint, r bigint")


def mined(
    embeddings: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
    references: int = REFERENCES, anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score."""
    rows = prepared(embeddings)
    directions = fit_references(rows, references)
    refs, width = directions.shape
    rows = placed(rows, directions)
    everything = blocks(rows, directions, row_block)
    anchors = blocks(rows.where(F.col("vec_id") % anchor_every == 0), directions, anchor_block)
    best = stored(positives_of(anchors, everything, width, refs, positives), "positives")

    score = F.col("positive_score")
    # Whole numbers: the least s with LOW * score <= 100 * s is a ceiling.
    low = F.expr(f"-floor(-{LOW} * cast(positive_score AS decimal(30,0)) / 100)")
    high = F.expr(f"floor({HIGH} * cast(positive_score AS decimal(30,0)) / 100)")
    asked = best.where(score >= 0).groupBy("number").agg(
        F.collect_list(F.struct("place", "window", "positive_score")).alias("windows"),
        F.min(low).cast("double").alias("low"), F.max(high).cast("double").alias("high"),
    )
    asked = stored(anchors.join(asked, "number"), "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mine, theirs, x in _sides(batch, width, refs):
                windows: list[list[tuple[int, int]]] = [[] for _ in mine.ids]
                for w in sorted(x["a_windows"], key=lambda w: (w["place"], w["window"])):
                    windows[w["place"]].append(bounds_of(w["positive_score"]))
                found = [
                    (mine.number, place, window, got, vec_id if named else None)
                    for place, window, got, vec_id, named in best_in_windows(mine, windows, theirs, negatives)
                ]
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield _table(found, ["number", "place", "window", "score", "id"], types)

    tiles = _tiles(asked, everything)
    found = _met(tiles, asked, everything, "windows").mapInArrow(run, INSIDE)
    order = Window.partitionBy("number", "place", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return best.join(found, ["number", "place", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
