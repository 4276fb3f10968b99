"""Leaf tables against the definition of the Shapley value."""

from itertools import combinations
from math import factorial

import numpy as np

import pytest

from churnloom.operators import explanation
from churnloom.operators.explanation import (
    Leaf,
    _leaves_below,
    base_value,
    contributions,
    path_contributions,
)


class Node:
    def __init__(self, id, cover, prediction=0.0, left=-1, right=-1, feature=-1, threshold=0.0):
        self.id, self.cover, self.prediction = id, cover, prediction
        self.leftChild, self.rightChild, self.featureIndex, self.threshold = left, right, feature, threshold


# Feature 0 is used twice on one path; feature 2 not at all.
TREE = {
    0: Node(0, 100, left=1, right=2, feature=0, threshold=5.0),
    1: Node(1, 60, left=3, right=4, feature=1, threshold=1.0),
    2: Node(2, 40, prediction=3.0),
    3: Node(3, 45, left=5, right=6, feature=0, threshold=2.0),
    4: Node(4, 15, prediction=-1.0),
    5: Node(5, 30, prediction=0.5),
    6: Node(6, 15, prediction=2.0),
}


def known_value(x, known, node_id=0):
    """Expected output when only some features are known (covers weigh the rest)."""
    node = TREE[node_id]
    if node.leftChild < 0:
        return node.prediction
    left, right = node.leftChild, node.rightChild
    if node.featureIndex in known:
        return known_value(x, known, left if x[node.featureIndex] <= node.threshold else right)
    a, b = TREE[left].cover, TREE[right].cover
    return (a * known_value(x, known, left) + b * known_value(x, known, right)) / (a + b)


def shapley(x, n=3):
    out = []
    for i in range(n):
        others = [j for j in range(n) if j != i]
        total = 0.0
        for size in range(n):
            for subset in combinations(others, size):
                weight = factorial(size) * factorial(n - 1 - size) / factorial(n)
                total += weight * (known_value(x, {*subset, i}) - known_value(x, set(subset)))
        out.append(total)
    return out


def test_same_as_definition():
    leaves = tuple(_leaves_below(TREE, 0, {}, 1.0))
    assert all(isinstance(leaf, Leaf) for leaf in leaves)
    rows = np.array([[a, b, 0.0] for a in (1.0, 2.0, 3.0, 5.0, 6.0) for b in (0.0, 1.0, 2.0)])
    got = contributions(rows, leaves)
    for x, phi in zip(rows, got):
        assert np.allclose(phi, shapley(x))
        assert np.isclose(base_value(leaves) + phi.sum(), known_value(x, {0, 1, 2}))


def by_subsets(met, share, value):
    """The definition, with the subsets of each size summed up feature by feature."""
    n, d = met.shape
    out = np.empty((n, d))
    weight = np.array([factorial(k) * factorial(d - 1 - k) / factorial(d) for k in range(d)])
    for i in range(d):
        sizes = np.zeros((n, d))
        sizes[:, 0] = 1.0
        for j in (j for j in range(d) if j != i):
            grown = np.roll(sizes, 1, axis=1) * met[:, [j]]
            grown[:, 0] = 0.0
            sizes = sizes * share[j] + grown
        out[:, i] = value * (met[:, i] - share[i]) * (sizes @ weight)
    return out


@pytest.mark.parametrize("d", [1, 2, 5, 9, 12, 18, 30])
def test_paths_of_any_depth(d):
    draw = np.random.default_rng(d)
    met = draw.integers(0, 2, (200, d))
    met[0], met[1] = 0, 1
    share = draw.uniform(0.02, 0.98, d)
    got = path_contributions(met, share, 3.5)
    assert np.allclose(got, by_subsets(met, share, 3.5), rtol=1e-9, atol=1e-12)
    reached = np.where(met.all(axis=1), 3.5, 0.0)
    assert np.allclose(got.sum(axis=1) + 3.5 * share.prod(), reached)


def test_deep_paths_are_not_remembered_whole():
    draw = np.random.default_rng(1)
    deep = Leaf(2.0, tuple(range(18)), (0.0,) * 18, (1.0,) * 18, tuple(draw.uniform(0.1, 0.9, 18)))
    flat = Leaf(-1.0, (3,), (0.5,), (np.inf,), (0.25,))
    explanation._remembered.cache_clear()
    assert list(explanation._remembered((deep, flat))) == [1, 0]
    explanation._remembered.cache_clear()
    before, explanation.REMEMBERED = explanation.REMEMBERED, 1000
    try:
        rows = draw.uniform(-0.2, 1.2, (500, 18))
        got = contributions(rows, (deep, flat))
        assert list(explanation._remembered((deep, flat))) == [1]
    finally:
        explanation.REMEMBERED = before
        explanation._remembered.cache_clear()
    assert np.allclose(got, contributions(rows, (deep, flat)))
