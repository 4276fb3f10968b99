"""Token ids of documents as compressed, addressable blocks.

Method: one zstandard dictionary is trained on serialised id arrays of a bounded
sample and shared by all documents; every document is compressed on its own, so a
short document can be read alone and still compresses well. A store is a folder:

``dictionary``  one row: sha256, bytes, bytes per id, the id that ends a document.
``blocks``      a row holds some hundred documents in ascending doc_id order:
                ``part``, ``block``, ``first_start`` (ids of the part before it),
                ``first_doc``, ``last_doc``, ``doc_ids``, ``offsets`` (of the frames,
                one more than documents), ``n_tokens``, ``dict_sha256``, ``frames``.

Defined results: null text counts as empty and gives the end id alone; null doc_id
sorts first; repeated rows are each stored; an empty table gives an empty store;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnloom.llm.common import texts
from churnloom.llm.pieces import PieceValues, byte_letters, pieces

#: Documents the dictionary is trained on, at most, and their lengths in characters.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = (100, 20_000)
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
#: A block is closed at so many documents or bytes of ids.
BLOCK_DOCS = 256
BLOCK_BYTES = 1 << 20

BLOCKS = (
    "part int, block int, first_start bigint, first_doc bigint, last_doc bigint,"
    " doc_ids array<bigint>, offsets array<bigint>, n_tokens array<bigint>,"
    " dict_sha256 string, frames binary"
)


class IdPieces:
    """Ids of texts, serialised, by the tokenizers library.

    The library encodes every piece it has not seen yet: pieces of letters by its
    model, after its normaliser and in the byte alphabet, all others as a whole.
    """

    def __init__(self, tokenizer: str, width: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(tokenizer)
        self.dtype = np.dtype(f"<u{width}")
        self.normalise = self.tok.normalizer.normalize_str if self.tok.normalizer else str
        #: None unless words are runs of letters in the byte alphabet.
        self.letters = None
        probe = "ab\u00e9 c"
        parts = [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(probe)]
        if parts == [byte_letters(w) for w in probe.split()]:
            self.letters = self.tok.model.tokenize
        self.memo = PieceValues(self._words, self._any, lambda a, b: a + b, b"")

    def _any(self, piece: str) -> bytes:
        return np.array(
            self.tok.encode(piece, add_special_tokens=False).ids, dtype=self.dtype
        ).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        letters, code = self.letters, f"<{{}}{'H' if self.dtype.itemsize == 2 else 'I'}"
        if letters is None:
            return [self._any(w) for w in words]
        whole = self.normalise(" ".join(words)).split(" ")
        out = []
        for word, plain in zip(words, whole, strict=True):
            if plain.isalpha():
                ids = [t.id for t in letters(byte_letters(plain))]
                out.append(struct.pack(code.format(len(ids)), *ids))
            else:  # a mark came off a letter
                out.append(self._any(word))
        return out

    def of(self, text: str) -> bytes:
        return b"".join(self.memo.values(pieces(text)))


@lru_cache(maxsize=1)
def _of_worker(tokenizer: str, width: int) -> IdPieces:
    """One for all tasks of a Python worker, so that a piece is encoded once in each worker
    and not in each task; what it remembers is bounded by generations."""
    return IdPieces(tokenizer, width)


def id_width(tokenizer: str) -> int:
    """Bytes per stored id: two if all ids fit, else four."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4


def train_dictionary(docs: DataFrame, tokenizer: str, width: int) -> bytes:
    """Dictionary from at most SAMPLE_DOCS documents, chosen by a hash of doc_id.

    Which documents are drawn changes sizes on disk, never what is read back. Too
    little text to train on gives plain content, none an empty dictionary.
    """
    rows = texts(docs)
    share = min(1.0, 2.0 * SAMPLE_DOCS / max(1, docs.count()))
    drawn = (
        rows.where(F.length("text").between(*SAMPLE_CHARS))
        .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        .limit(SAMPLE_DOCS)
    )
    ids = IdPieces(tokenizer, width)
    samples = [ids.of(r.text) for r in drawn.select("text").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(raw: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}


def _writer(tokenizer: str, width: int, dictionary: bytes, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _of_worker(tokenizer, width)
        end = np.array([end_id], dtype=ids.dtype).tobytes()
        press = zstandard.ZstdCompressor(level=LEVEL, **_dictionary(dictionary))
        sha = hashlib.sha256(dictionary).hexdigest()
        schema = pa.schema(
            [("part", pa.int32()), ("block", pa.int32())]
            + [(c, pa.int64()) for c in ("first_start", "first_doc", "last_doc")]
            + [(c, pa.list_(pa.int64())) for c in ("doc_ids", "offsets", "n_tokens")]
            + [("dict_sha256", pa.string()), ("frames", pa.binary())]
        )
        part, block, start, total = TaskContext.get().partitionId(), 0, 0, 0
        doc_ids, frames, counts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, frames)]).tolist()
            row = [part, block, start, doc_ids[0], doc_ids[-1], doc_ids, offsets, counts, sha]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip([*row, b"".join(frames)], schema)],
                schema=schema,
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = ids.of(text.as_py()) + end
                doc_ids.append(doc_id)
                frames.append(press.compress(raw))
                counts.append(len(raw) // width)
                held += len(raw)
                total += counts[-1]
                if len(doc_ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield close()
                    block, start = block + 1, total
                    doc_ids, frames, counts, held = [], [], [], 0
        if doc_ids:
            yield close()

    return run


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every document and write the store, in ascending doc_id order.

    The range partitions are dealt by doc_id, then text, then place in the input, so
    that neither one id nor one text makes a large partition.
    """
    spark = docs.sparkSession
    width = id_width(tokenizer)
    dictionary = train_dictionary(docs, tokenizer, width)
    spark.createDataFrame(
        [(hashlib.sha256(dictionary).hexdigest(), dictionary, width, end_id)],
        "sha256 string, bytes binary, width int, end_id int",
    ).coalesce(1).write.parquet(f"{path}/dictionary")
    placed = texts(docs).withColumns(
        {"_h": F.xxhash64("text"), "_m": F.monotonically_increasing_id()}
    )
    (
        placed.repartitionByRange("doc_id", "_h", "_m")
        .sortWithinPartitions("doc_id", "_h", "_m")
        .select("doc_id", "text")
        .mapInArrow(_writer(tokenizer, width, dictionary, end_id), BLOCKS)
        .write.parquet(f"{path}/blocks")
    )


def _header(spark: SparkSession, path: str) -> tuple[str, bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    return row.sha256, bytes(row.bytes), row.width


def _frames(batches: Iterator[pa.RecordBatch], sha: str, dictionary: bytes, width: int):
    """(doc_id, start, ids) of every document of the blocks."""
    plain = zstandard.ZstdDecompressor(**_dictionary(dictionary))
    for batch in batches:
        for row in range(batch.num_rows):
            at = {n: batch.column(n)[row] for n in batch.schema.names}
            if at["dict_sha256"].as_py() != sha:
                raise ValueError("a block was written with another dictionary")
            frames = memoryview(at["frames"].as_buffer())
            offsets, start = at["offsets"].as_py(), at["first_start"].as_py()
            for k, doc_id in enumerate(at["doc_ids"].as_py()):
                raw = plain.decompress(frames[offsets[k] : offsets[k + 1]])
                ids = np.frombuffer(raw, dtype=f"<u{width}")
                yield doc_id, start, ids
                start += len(ids)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with the number of ids before them in the whole store."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    tokens = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        blocks.groupBy("part")
        .agg(F.sum(tokens).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    )  # one row per written partition
    return blocks.join(F.broadcast(parts), "part").withColumn(
        "first_start", F.col("first_start") + F.col("_before")
    )


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and crc32 of the ids of every stored document."""
    sha, dictionary, width = _header(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            rows = [
                (d, s, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                for d, s, ids in _frames([batch], sha, dictionary, width)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)], names=names
                )

    return (
        _placed(spark, path)
        .select("doc_ids", "offsets", "first_start", "dict_sha256", "frames")
        .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def read_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of some documents: only blocks that may hold them are read, and of those
    only the frames of the documents are decompressed."""
    sha, dictionary, width = _header(spark, path)
    wanted = set(doc_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor(**_dictionary(dictionary))
        for batch in batches:
            got = []
            for row in batch.to_pylist():
                if row["dict_sha256"] != sha:
                    raise ValueError("a block was written with another dictionary")
                for k, d in enumerate(row["doc_ids"]):
                    if d in wanted:
                        raw = plain.decompress(row["frames"][slice(*row["offsets"][k : k + 2])])
                        got.append((d, np.frombuffer(raw, dtype=f"<u{width}").tolist()))
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.list_(pa.int64()))],
                    names=["doc_id", "ids"],
                )

    if not wanted:
        return spark.createDataFrame([], "doc_id bigint, ids array<bigint>")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # Null ids sort first, so a block that begins with one may hold any smaller id.
    near = F.coalesce(F.col("first_doc") <= max(wanted), F.lit(True)) & (F.col("last_doc") >= min(wanted))
    return (
        blocks.where(near)
        .where(F.arrays_overlap("doc_ids", F.array(*[F.lit(d).cast("bigint") for d in sorted(wanted)])))
        .select("doc_ids", "offsets", "dict_sha256", "frames")
        .mapInArrow(run, "doc_id bigint, ids array<bigint>")
    )
