"""MinHash groups against all pairs; sketches against their guarantees."""

import random

import brute
import numpy as np
from conftest import bag

from churnloom.llm import minhash


def test_real(make, real):
    assert bag(minhash.groups(make(real)).collect()) == bag(brute.minhash_groups(real))


def test_odd_rows(make, odd):
    assert bag(minhash.groups(make(odd)).collect()) == bag(brute.minhash_groups(odd))
    assert minhash.groups(make(odd).limit(0)).collect() == []


def _near_copies(n, seed):
    """Chains and stars of texts around the bound of 0.85."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(draw.randrange(8)):
            at = draw.randrange(len(text))
            text[at : at + draw.randrange(2)] = [f"x{draw.randrange(50)}"]
        if i % 11 == 0:
            base = text
        rows.append((i if i % 13 else None, " ".join(text)))
    return rows


def test_one_hot_group_in_small_blocks(make):
    rows = _near_copies(260, 5) + [(1000 + i, "the same short text") for i in range(90)]
    expected = bag(brute.minhash_groups(rows))
    assert len({r[2] for r in expected}) > 20
    for block, block_shingles in ((1024, 1_000_000), (16, 1_000_000), (64, 900)):
        assert bag(minhash.groups(make(rows), block=block, block_shingles=block_shingles).collect()) == expected


def test_every_coordinate_is_filled_and_counts_similarity():
    draw = np.random.default_rng(3)
    for size in (1, 2, 3, 40, 700, 20_000):
        found = minhash.sketch(draw.integers(1, 2**63, size, dtype=np.uint64))
        assert found.max() < np.iinfo(np.uint64).max
    shares = []
    for _ in range(60):
        x = draw.integers(1, 2**63, 230, dtype=np.uint64)
        a, b = minhash.sketch(x[:215]), minhash.sketch(x[15:])  # 200 of 230 in both
        shares.append((a == b).mean())
    assert abs(np.mean(shares) - 200 / 230) < 0.012
    assert np.std(shares) < 0.04


def test_very_long_text(make):
    words = [f"w{i}" for i in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "end"])), (3, " ".join(words[100_000:]))]
    assert [r[2] for r in sorted(minhash.groups(make(rows)).collect())] == [1, 1, 3]
