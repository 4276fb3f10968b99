"""Hard negatives against every pair, and the bounds against every score."""

import brute
import numpy as np
import pytest
from conftest import bag

from churnloom.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, v int, cone int, number int"


def table(spark, rows, parts=4):
    full = [(*r, "x", 1, 2, 3) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def vectors(n, dims=12, labels=5, seed=0, clusters=4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, dims))
    v = centres[draw.integers(clusters, size=n)] + draw.normal(size=(n, dims)) * 0.5
    v = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)
    return [(i, v[i].tolist(), int(draw.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("anchor_block,row_block", [(1024, 4096), (3, 50)])
def test_as_all_pairs(spark, anchor_block, row_block):
    rows = vectors(700) + [(1000 + i, vectors(1)[0][1], 2) for i in range(60)]
    found = H.mined(table(spark, rows), anchor_block=anchor_block, row_block=row_block)
    expected = brute.hard_negatives(rows)
    assert len(expected) > 100
    assert bag(found.collect()) == bag(expected)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    plain = vectors(150, dims=3)
    rows = [
        *plain, (50, plain[50][1], plain[50][2]), (50, [1.0, 2.0, 3.0], 1), (None, [0.5, 0.5, 0.5], 2),
        (None, [0.5, 0.5, 0.5], 1), (300, None, 1), (350, [1.0, 2.0, 3.0], None), (400, [nan, 1.0, 1.0], 1),
        (450, [inf, 1.0, 1.0], 1), (500, [1.0, None, 1.0], 1), (550, [], 1), (600, [0.0, 0.0, 0.0], 1),
        (650, [0.7], 3), (700, [0.3, 0.4, 0.5], -5), (701, [-0.3, -0.4, -0.5], -4), (750, [900.0, 5e3, -1e3], 2),
    ]
    full = [(a, None if v is None else [*v, *[0.0] * (3 - len(v))], c) for a, v, c in rows]
    assert bag(H.mined(table(spark, rows)).collect()) == bag(brute.hard_negatives(full))


def test_empty_and_without_anchors(spark):
    assert H.mined(table(spark, [])).collect() == []
    assert H.mined(table(spark, [(1, [1.0], 1), (2, [1.0], 2)])).collect() == []
    assert H.mined(table(spark, [(0, [1.0], 1)])).collect() == []


def test_too_long_vectors_take_no_part(spark):
    plain = vectors(120, dims=3)
    rows = [*plain, (200, [3e38, 1.0, 1.0], 1), (250, [2.0**24, 0.0, 0.0], 2)]
    assert bag(H.mined(table(spark, rows)).collect()) == bag(brute.hard_negatives(plain))


def test_bounds_hold():
    draw = np.random.default_rng(4)
    for scale in (1, 300, 2**20):
        v = np.floor(draw.normal(size=(400, 6)) * scale)
        v[:20] = v[20:40]
        v[40:50] = -v[50:60]
        v[60] = 0
        refs = v[[0, 70, 80, 90]] / np.linalg.norm(v[[0, 70, 80, 90]], axis=1)[:, None] if scale > 1 else np.eye(6)
        norms = np.sqrt((v * v).sum(axis=1))
        columns = np.column_stack([norms, H.angles_to(v, norms, refs)])
        least, most = H.intervals(columns[:, None], columns[:, None], columns[None], columns[None])
        scores = v @ v.T
        assert (least <= scores).all() and (scores <= most).all()
        assert scale == 1 or (most - least < 0.9 * (norms[:, None] * norms)).any()


def test_large_scores_are_exact():
    draw = np.random.default_rng(5)
    rows = draw.integers(-(2**27), 2**27, (50, 8)).astype(float)
    exact = [sum(int(x) * int(y) for x, y in zip(rows[0], r)) for r in rows]
    assert H._scores(rows[0], rows).tolist() == exact


def test_windows_are_whole_numbers():
    for score in (0, 1, 2, 3, 99, 100, 101, 2**61, 2**61 + 1):
        low, high = H.bounds_of(score)
        assert 50 * score <= 100 * low and 100 * (low - 1) < 50 * score
        assert 100 * high <= 95 * score and 95 * score < 100 * (high + 1)
