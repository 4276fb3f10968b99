"""Feature contributions of boosted trees (path-dependent Shapley values).

For one leaf, only the features on its path matter, and a row enters only through which
of their conditions it meets. The subsets of the path's features are never listed: their
weights, summed by size, are the coefficients of a product with one factor for each
feature. A path is extended by multiplying a factor in, and a feature is unwound by
dividing its own out, so a path of d features costs d * d steps whatever its depth. Rows
of a batch that meet the same conditions are computed once; the values of short paths are
remembered up to a bound. The model is small; the rows are spread over tasks and handled
in Arrow batches.

Method: Lundberg et al., "Consistent Individualized Feature Attribution for Tree
Ensembles", 2018.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom import fixed

# The classifier's log-odds are twice its raw margin.
LOG_ODDS_PER_MARGIN = 2.0
# Contributions (numbers) of all patterns of short paths that a worker remembers.
REMEMBERED = 8_000_000


@dataclass(frozen=True)
class Leaf:
    """A leaf with, per feature on its path, the interval (low, high] that leads
    to it and the share of training weight that takes it."""

    value: float
    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    share: tuple[float, ...]


def read_leaves(spark: SparkSession, model_path: str, weights: list[float]) -> tuple[Leaf, ...]:
    """Leaves of a saved model. Its size depends on trees and depth, not on data."""
    nodes = spark.read.parquet(f"{model_path}/data").select(
        "treeID",
        "nodeData.id",
        "nodeData.prediction",
        F.get("nodeData.impurityStats", 0).alias("cover"),
        "nodeData.leftChild",
        "nodeData.rightChild",
        "nodeData.split.featureIndex",
        F.get("nodeData.split.leftCategoriesOrThreshold", 0).alias("threshold"),
    )
    trees: dict[int, dict[int, object]] = {}
    for row in nodes.collect():
        trees.setdefault(row.treeID, {})[row.id] = row
    leaves: list[Leaf] = []
    for tree, rows in trees.items():
        leaves += _leaves_below(rows, 0, {}, weights[tree] * LOG_ODDS_PER_MARGIN)
    return tuple(leaves)


def _leaves_below(rows: dict, node_id: int, path: dict, scale: float) -> Iterator[Leaf]:
    node = rows[node_id]
    if node.leftChild < 0:
        features = tuple(sorted(path))
        low, high, share = zip(*(path[f] for f in features)) if features else ((), (), ())
        yield Leaf(node.prediction * scale, features, low, high, share)
        return
    f = node.featureIndex
    low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
    for child, interval in (
        (node.leftChild, (low, min(high, node.threshold))),
        (node.rightChild, (max(low, node.threshold), high)),
    ):
        taken = share * rows[child].cover / node.cover
        yield from _leaves_below(rows, child, {**path, f: (*interval, taken)}, scale)


def base_value(leaves: tuple[Leaf, ...]) -> float:
    """Expected margin over the training weight."""
    return float(sum(leaf.value * np.prod(leaf.share) for leaf in leaves))


def path_contributions(met: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    """Contributions of a path's features (columns) for rows of met conditions.

    ``whole[:, k]`` is the summed weight of the subsets of k known features. Divided by a
    feature's own factor (its share, plus a known one if its condition is met) it is that
    of the subsets without the feature, from the largest size down.
    """
    n, d = met.shape
    met = met.astype(bool)
    whole = np.zeros((n, d + 1))
    whole[:, 0] = 1.0
    for j in range(d):
        known = np.where(met[:, [j]], whole[:, :-1], 0.0)
        whole *= share[j]
        whole[:, 1:] += known
    divisor = np.where(share > 0, share, 1.0)
    without = np.zeros((n, d))
    total = np.zeros((n, d))
    for k in range(d - 1, -1, -1):
        without = np.where(met, whole[:, [k + 1]] - share * without, whole[:, [k]] / divisor)
        total += without / (d * comb(d - 1, k))
    return value * (met - share) * total


@lru_cache(maxsize=4)
def _remembered(leaves: tuple[Leaf, ...]) -> dict[int, np.ndarray]:
    """By the leaf's place: the contributions for every pattern of met conditions, of the
    shortest paths."""
    found, numbers = {}, 0
    for k in sorted(range(len(leaves)), key=lambda k: len(leaves[k].features)):
        d = len(leaves[k].features)
        numbers += d * 2**d
        if numbers > REMEMBERED:
            break
        patterns = (np.arange(2**d)[:, None] >> np.arange(d)) & 1
        found[k] = path_contributions(patterns, np.asarray(leaves[k].share), leaves[k].value)
    return found


def contributions(x: np.ndarray, leaves: tuple[Leaf, ...]) -> np.ndarray:
    """Contributions (rows x features) of a block of rows."""
    out = np.zeros(x.shape)
    known = _remembered(leaves)
    for k, leaf in enumerate(leaves):
        if not leaf.features:
            continue
        used = list(leaf.features)
        block = x[:, used]
        met = (block > np.asarray(leaf.low)) & (block <= np.asarray(leaf.high))
        if k in known:
            out[:, used] += known[k][met @ (1 << np.arange(len(used)))]
        else:
            packed = np.packbits(met, axis=1)
            _, first, which = np.unique(packed, axis=0, return_index=True, return_inverse=True)
            values = path_contributions(met[first], np.asarray(leaf.share), leaf.value)
            out[:, used] += values[which.reshape(-1)]
    return out


def of_rows(x: np.ndarray, leaves: tuple[Leaf, ...]) -> np.ndarray:
    """As ``contributions``, with equal rows computed once: all unknown users look alike."""
    whole = np.ascontiguousarray(x).view(f"V{x.itemsize * x.shape[1]}").reshape(-1)
    _, first, which = np.unique(whole, return_index=True, return_inverse=True)
    return contributions(x[first], leaves)[which.reshape(-1)]


def explain(
    prepared: DataFrame, model: GBTClassificationModel, model_path: str, keep: list[str] | None = None
) -> DataFrame:
    """Rows with ``contributions`` array<struct<feature, value>> and ``base_value``.

    A positive value raises the churn risk. ``model_path`` is where ``model`` was
    saved.
    """
    spark = prepared.sparkSession
    leaves = read_leaves(spark, model_path, list(model.treeWeights))
    shared = spark.sparkContext.broadcast(leaves)
    base = base_value(leaves)
    names = list(fixed.FEATURES)
    keep = keep or ["msno"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = of_rows(batch[names].to_numpy(dtype=float), shared.value)
            yield batch[keep].assign(shap=list(values))

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prepared.select(*keep).schema)
    explained = prepared.select(
        *keep, *[F.col(c).cast("double").alias(c) for c in names if c not in keep]
    ).mapInPandas(run, f"{kept}, shap array<double>")
    pairs = F.transform(
        F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("shap").alias("value")),
        lambda p: F.struct(p["feature"].alias("feature"), p["value"].alias("value")),
    )
    return explained.select(*keep, pairs.alias("contributions"), F.lit(base).alias("base_value"))
