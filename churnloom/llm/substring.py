"""Removal of word windows that occur elsewhere, by fixed-block anchors.

Method: the reference blocks are the non-overlapping runs of ``block`` words at each
document's positions 0, block, 2*block ... With block = (window + 1) // 2 every window
of the corpus holds exactly one whole reference block of its own document (for an odd
window), and a window that also starts elsewhere makes that block occur elsewhere. So:

1. Words are packed into chunks of about a million words, kept in a table that is
   bucketed by chunk, so that later joins move no text and a task reads few chunks.
2. Every rolling window of ``block`` words is a probe into the index of reference
   blocks. Chunk by chunk the different hashes are packed and dealt by hash; the answer
   is one bit per hash: a reference block that occurs more than once.
3. Each anchor hit is extended: the up to ``block`` windows around a hit are hashed whole
   and answered in the same way. Runs of neighbouring repeated windows are the maximal
   repeats; their words go.

A chunk sends a hash once however often it holds it, so a window that a third of all
documents share is one entry per chunk, not one per document. What a task holds is bounded
by a chunk's words and by ``PART_HASHES``, whatever the number of documents. A probe is compared by 48
bits and its part, a window by 96 bits; a false probe costs work only.

Defined results: null text has no words; its row and repeated rows are returned, and
identical texts repeat each other; null doc_id is kept; an empty table gives an empty
table; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.llm.common import rolling, texts, words_of
from churnloom.session import scratch, stored

WINDOW = 35
#: Words per chunk; documents are not cut. It sets task sizes, not results.
CHUNK_WORDS = 1_000_000
#: Words that are Python objects at the same time.
SLICE_WORDS = 1 << 16
#: Hashes that a task compares at most.
PART_HASHES = 2_000_000
#: Hashes that a worker hands over at a time.
BATCH_HASHES = 1 << 18
#: Bytes of a hash that are sent: of a probe, of a window.
PROBE_BYTES, WINDOW_BYTES = 6, 12

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
CHUNKS = "chunk bigint, doc_ids array<bigint>, counts array<bigint>, words binary"
QUESTION = "chunk bigint, part int, packed binary"
REPLY = "chunk bigint, part int, bits binary"


def parts_for(words: int) -> int:
    """Tasks that answer: about 100 * sqrt(words) hashes each, one to two million, so
    that neither a task nor the packets between chunks and tasks get out of hand."""
    return 1 + words // min(PART_HASHES, max(1_000_000, 100 * math.isqrt(words)))


# --- chunks ----------------------------------------------------------------------------
def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in input order; their numbers hold the number of the task's partition."""
    chunk = TaskContext.get().partitionId() << 32
    ids, counts, held, n = [], [], [], 0

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int64())),
                pa.array([b" ".join(held)], pa.binary()),
            ],
            names=["chunk", "doc_ids", "counts", "words"],
        )

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            words = words_of(text.as_py())
            ids.append(doc_id)
            counts.append(len(words))
            if words:
                held.append(b" ".join(words))
            n += len(words)
            if n >= CHUNK_WORDS:
                yield close()
                chunk, ids, counts, held, n = chunk + 1, [], [], [], 0
    if ids:
        yield close()


class Chunk:
    """A chunk's word hashes and the places of its documents."""

    def __init__(self, counts: list[int], words: pa.Buffer, window: int) -> None:
        self.words = memoryview(words)
        self.counts = np.array(counts, dtype=np.int64)
        self.ends = np.cumsum(self.counts)
        self.window, self.block = window, (window + 1) // 2
        self.n = int(self.ends[-1])
        #: Where a word begins in ``words``; one more, as if another word followed.
        self.starts = np.zeros(self.n + 1 if self.n else 0, dtype=np.int64)
        if self.n:
            self.starts[1:-1] = np.flatnonzero(np.frombuffer(self.words, np.uint8) == 32) + 1
            self.starts[-1] = len(self.words) + 1
        self.hashes = self._hashed()

    def text(self, first: int, end: int) -> bytes:
        """The words from ``first`` to before ``end``, a space between each two."""
        return bytes(self.words[self.starts[first] : self.starts[end] - 1]) if first < end else b""

    def _hashed(self) -> np.ndarray:
        out = np.empty(self.n, dtype=np.uint64)
        for at in range(0, self.n, SLICE_WORDS):
            end = min(self.n, at + SLICE_WORDS)
            hashed = map(xxhash.xxh3_64_intdigest, self.text(at, end).split(b" "))
            out[at:end] = np.fromiter(hashed, np.uint64, end - at)
        return out

    def _place(self) -> np.ndarray:
        """Words before each in its document."""
        return np.arange(self.n) - np.repeat(self.ends - self.counts, self.counts)

    def _fits(self, width: int) -> np.ndarray:
        """Whether ``width`` words of the document are left from each word on."""
        return np.repeat(self.ends, self.counts) - np.arange(self.n) >= width

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions and hashes of all block-wide windows; which are reference blocks."""
        at = np.flatnonzero(self._fits(self.block))
        anchors = self._place()[at] % self.block == 0
        return at, rolling(self.hashes, self.block, _BASES[0])[at], anchors

    def around(self, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions and two hashes of every window that holds a reference block hit."""
        reach = self.window - self.block
        near = np.zeros(self.n + 1, dtype=np.int32)
        # A window of the document starts at most ``reach`` words before the block.
        first = hits - np.minimum(reach, self._place()[hits])
        np.add.at(near, first, 1)
        np.add.at(near, hits + 1, -1)
        at = np.flatnonzero((np.cumsum(near[:-1]) > 0) & self._fits(self.window))
        a, b = (rolling(self.hashes, self.window, base)[at] for base in _BASES[1:])
        return at, a, b


# --- questions and answers ---------------------------------------------------------------
class Questions:
    """The different keys (with ``extra``) of a chunk, in order, and the parts that answer.

    A question goes to the part given by the key's first bits: a byte of flags, 1: it occurs
    twice or more in the chunk, 2: it is asked for; then low bytes of the key (and of ``extra``).
    """

    def __init__(self, key: np.ndarray, extra: np.ndarray | None, asked: np.ndarray, n_parts: int) -> None:
        self.order = np.argsort(key) if extra is None else np.lexsort((extra, key))
        k = key[self.order]
        new = np.ones(len(k), dtype=bool)
        np.not_equal(k[1:], k[:-1], out=new[1:])
        if extra is not None:
            e = extra[self.order]
            new[1:] |= e[1:] != e[:-1]
        first = np.flatnonzero(new)
        self.sizes = np.diff(first, append=len(k))
        k = k[first]
        width = PROBE_BYTES if extra is None else WINDOW_BYTES
        self.packed = np.empty((len(first), 1 + width), dtype=np.uint8)
        self.packed[:, 0] = self.sizes > 1
        if len(first):
            self.packed[:, 0] |= np.maximum.reduceat(asked[self.order].astype(np.uint8), first) << 1
        self.packed[:, 1:9] = k.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : min(width, 8)]
        if extra is not None:
            self.packed[:, 9:] = e[first].astype("<u4").view(np.uint8).reshape(-1, 4)
        part = ((k >> np.uint64(40)) * np.uint64(n_parts)) >> np.uint64(24)
        cuts = np.searchsorted(part, np.arange(n_parts + 1, dtype=np.uint64))
        #: Parts that are asked anything, and where their questions begin and end.
        self.parts = np.flatnonzero(np.diff(cuts))
        self.cuts = np.append(cuts[self.parts], len(first))

    def packets(self, chunk: int) -> Iterator[pa.RecordBatch]:
        """A row for each part, in batches of about ``BATCH_HASHES``."""
        at, width = 0, self.packed.shape[1]
        while at < len(self.parts):
            end = max(at + 1, int(np.searchsorted(self.cuts, self.cuts[at] + BATCH_HASHES, "right")) - 1)
            cuts, n = self.cuts[at : end + 1], end - at
            offsets = pa.py_buffer(((cuts - cuts[0]) * width).astype(np.int32))
            packed = pa.py_buffer(self.packed[cuts[0] : cuts[-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk] * n, pa.int64()),
                    pa.array(self.parts[at:end], pa.int32()),
                    pa.Array.from_buffers(pa.binary(), n, [None, offsets, packed]),
                ],
                names=["chunk", "part", "packed"],
            )
            at = end

    def answers(self, replies: list[dict] | None) -> np.ndarray:
        """The answer of every key, in the order of the keys."""
        got = {a["part"]: a["bits"] for a in replies or ()}
        bits = [
            np.unpackbits(np.frombuffer(got[part], np.uint8), count=n)
            for part, n in zip(self.parts.tolist(), np.diff(self.cuts).tolist())
        ]
        out = np.zeros(len(self.order), dtype=bool)
        if bits:
            out[self.order] = np.repeat(np.concatenate(bits).astype(bool), self.sizes)
        return out


def _answer(width: int):
    def run(question: pa.Table) -> pa.Table:
        """One bit per question: the key came from several chunks or is repeated in
        one, and is asked for by any."""
        raw = [np.frombuffer(q.as_buffer(), np.uint8).reshape(-1, 1 + width) for q in question.column("packed")]
        n = sum(map(len, raw))
        # A long key has 8 bytes in ``lead``; ``rest`` has its others and, lowest, the flags.
        n_lead = 8 if width > 7 else 0
        lead, rest, at = np.empty(n if n_lead else 0, np.uint64), np.empty(n, np.uint64), 0
        for r in raw:
            end = at + len(r)
            wide = np.zeros((len(r), 8), dtype=np.uint8)
            wide[:, 0] = r[:, 0]
            wide[:, 1 : 1 + width - n_lead] = r[:, 1 + n_lead :]
            rest[at:end] = wide.view("<u8")[:, 0]
            if n_lead:
                lead[at:end] = r[:, 1:9].copy().view("<u8")[:, 0]
            at = end
        order = np.lexsort((rest, lead)) if n_lead else np.argsort(rest)
        # Equal keys stand side by side; the last of them has the flag 2 if any has.
        ends = np.ones(n, dtype=bool)
        if n_lead:
            lead = lead[order]
            np.not_equal(lead[1:], lead[:-1], out=ends[:-1])
            del lead
        rest = rest[order]
        flags = rest.astype(np.uint8)
        rest >>= np.uint64(8)
        ends[:-1] = (ends[:-1] & bool(n_lead)) | (rest[1:] != rest[:-1])
        del rest
        at = np.flatnonzero(ends)
        sizes = np.diff(at, prepend=-1)
        hit = ((sizes > 1) | ((flags[at] & 1) > 0)) & ((flags[at] & 2) > 0)
        answer = np.empty(n, dtype=bool)
        answer[order] = np.repeat(hit, sizes)
        bits, at = [], 0
        for r in raw:
            bits.append(np.packbits(answer[at : at + len(r)]).tobytes())
            at += len(r)
        same = {c: question.column(c) for c in ("chunk", "part")}
        return pa.table({**same, "bits": pa.array(bits, pa.binary())})

    return run


def _ask(questions: DataFrame, width: int, name: str) -> DataFrame:
    """The answers for each chunk, as a list of (part, bits); one bit a hash."""
    answers = questions.groupBy("part").applyInArrow(_answer(width), REPLY)
    per_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias(name))
    return stored(per_chunk, name)


def _rows(batches: Iterator[pa.RecordBatch], window: int):
    for batch in batches:
        others = [n for n in batch.schema.names if n != "words"]
        for row in range(batch.num_rows):
            at = {n: batch.column(n)[row].as_py() for n in others}
            yield at, Chunk(at["counts"], batch.column("words")[row].as_buffer(), window)


def _around_hits(row: dict, chunk: Chunk, n_parts: int):
    at, h, anchors = chunk.probes()
    hit = Questions(h, None, anchors, n_parts).answers(row["hits"])
    return chunk.around(at[hit & anchors])


def _chunk_table(docs: DataFrame) -> DataFrame:
    """Chunks in a table bucketed by chunk: joins on it read whole buckets, in place."""
    spark = docs.sparkSession
    buckets = min(100_000, max(4 * spark.sparkContext.defaultParallelism, docs.count() // 2048))
    name = f"chunks_{uuid.uuid4().hex}"
    (
        texts(docs)
        .mapInArrow(_pack, CHUNKS)
        .write.bucketBy(buckets, "chunk")
        .options(path=scratch(spark, "chunks"), compression="zstd")
        .saveAsTable(name, format="parquet")
    )
    chunks = spark.table(name)
    # The name has served its purpose: the frame knows files and buckets, which stay.
    spark.sql(f"DROP TABLE {name}")
    return chunks


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, spans removed (pairs
    of word positions, end exclusive)."""
    if window % 2 == 0:
        raise ValueError("an even window could hold two whole reference blocks")
    chunks = _chunk_table(docs)
    counted = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    n_parts = parts_for(chunks.select(F.sum(counted)).first()[0] or 0)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, chunk in _rows(batches, window):
            _, h, anchors = chunk.probes()
            yield from Questions(h, None, anchors, n_parts).packets(row["chunk"])

    probes = chunks.select("chunk", "counts", "words").mapInArrow(probe, QUESTION)
    hits = _ask(probes, PROBE_BYTES, "hits").hint("shuffle_hash")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, chunk in _rows(batches, window):
            at, a, b = _around_hits(row, chunk, n_parts)
            yield from Questions(a, b, np.ones(len(at), bool), n_parts).packets(row["chunk"])

    with_hits = chunks.join(hits, "chunk", "left")
    windows = with_hits.select("chunk", "counts", "words", "hits").mapInArrow(extend, QUESTION)
    repeats = _ask(windows, WINDOW_BYTES, "repeats").hint("shuffle_hash")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, chunk in _rows(batches, window):
            at, a, b = _around_hits(row, chunk, n_parts)
            hit = Questions(a, b, np.ones(len(at), bool), n_parts).answers(row["repeats"])
            cover = np.zeros(chunk.n + 1, dtype=np.int32)
            np.add.at(cover, at[hit], 1)
            np.add.at(cover, at[hit] + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            n_removed, sha, spans, start = [], [], [], 0
            for end in chunk.ends.tolist():
                mask = gone[start:end]
                n_removed.append(int(mask.sum()))
                edges = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0])))).reshape(-1, 2)
                spans.append(edges.tolist())
                runs = zip([start, *(start + edges[:, 1]).tolist()], [*(start + edges[:, 0]).tolist(), end])
                kept = b" ".join(chunk.text(a, b) for a, b in runs if a < b)
                sha.append(hashlib.sha256(kept).hexdigest())
                start = end
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["counts"], pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"],
            )

    return (
        with_hits.join(repeats, "chunk", "left")
        .select("doc_ids", "counts", "words", "hits", "repeats")
        .mapInArrow(
            remove,
            "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string,"
            " spans array<array<bigint>>",
        )
    )
