"""What a task of operator 6 holds does not grow with the table."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnloom.llm import substring


def peak(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def asked(packets, width):
    """A part's questions: per chunk (key, flags) pairs."""
    rows = [b"".join(bytes([f]) + k.to_bytes(width, "little") for k, f in p) for p in packets]
    n = len(rows)
    return pa.table({"chunk": pa.array(range(n), pa.int64()), "part": pa.array([3] * n, pa.int32()), "packed": rows})


def test_hashes_of_a_task():
    for words in (0, 10**5, 10**8, 2 * 10**9, 10**10, 10**12):
        assert words / substring.parts_for(words) <= 2_000_000


@pytest.mark.parametrize("width", [substring.PROBE_BYTES, substring.WINDOW_BYTES])
def test_answers(width):
    rng = random.Random(width)
    # Keys that differ in their first or last bytes only are different keys.
    pool = [rng.getrandbits(4) | rng.getrandbits(3) << (8 * width - 3) for _ in range(150)]
    packets = [[(k, rng.randrange(4)) for k in {rng.choice(pool) for _ in range(n)}] for n in (40, 1, 60, 25)]
    flat = [q for p in packets for q in p]
    want = [
        [(sum(x == k for x, _ in flat) > 1 or any(f & 1 for x, f in flat if x == k)) and any(f & 2 for x, f in flat if x == k) for k, _ in p]
        for p in packets
    ]
    got = substring._answer(width)(asked(packets, width))
    assert got.column_names == ["chunk", "part", "bits"]
    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(p)).astype(bool).tolist() for b, p in zip(got["bits"].to_pylist(), packets)]
    assert bits == want
    assert any(map(any, want)) and not all(map(all, want))


@pytest.mark.parametrize("width", [substring.PROBE_BYTES, substring.WINDOW_BYTES])
def test_memory_of_answers(width):
    n = 400_000
    raw = np.random.default_rng(1).integers(0, 256, (4, n // 4, 1 + width), np.uint8)
    raw[:, :, 0] = raw[:, :, -1] = 2
    table = pa.table({"chunk": pa.array([1, 2, 3, 4], pa.int64()), "part": pa.array([0] * 4, pa.int32()), "packed": [r.tobytes() for r in raw]})
    _, most = peak(lambda: substring._answer(width)(table))
    assert most < 50 * n


def test_memory_of_a_chunk():
    rng = random.Random(5)
    words = [f"{rng.getrandbits(40):x}".encode() for _ in range(300_000)]
    buffer = pa.py_buffer(b" ".join(words))
    del words

    def run():
        chunk = substring.Chunk([100_000] * 3, buffer, substring.WINDOW)
        _, h, anchors = chunk.probes()
        return sum(b.num_rows for b in substring.Questions(h, None, anchors, 7).packets(1))

    rows, most = peak(run)
    assert rows == 7
    assert most < 110 * 300_000


def test_chunks_of_a_partition_are_dealt(spark):
    docs = spark.range(6).select(F.col("id").alias("doc_id"), F.expr("repeat('ab ', 1000000)").alias("text"))
    chunks = substring._chunk_table(docs.coalesce(1))
    assert chunks.count() == 6
    assert chunks.select(F.input_file_name()).distinct().count() > 3
