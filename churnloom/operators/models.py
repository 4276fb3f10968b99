"""Classifiers on the prepared features, with MLlib doing the distributed work."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions.running import running_sums
from churnloom.operators import evaluation
from churnloom.session import scratch, stored

VALIDATION_SHARE = 10  # per cent of the training users watched for early stopping
HIDDEN_LAYERS = [100, 50, 25]


def assembled(df: DataFrame) -> DataFrame:
    """Feature columns as one vector, in model order."""
    return VectorAssembler(inputCols=fixed.FEATURES, outputCol="features").transform(df)


def _held_out(percent: int) -> Column:
    """Fixed part of the users, chosen by hash of the id."""
    return F.pmod(F.xxhash64("msno"), F.lit(100)) < percent


def weighted(train: DataFrame, balanced: bool = False) -> DataFrame:
    """Row weights: positives by the class ratio, or both classes balanced."""
    counts = train.agg(
        F.count_if(F.col("is_churn") == 1).alias("p"), F.count_if(F.col("is_churn") == 0).alias("n")
    ).first()
    positives, negatives = max(counts.p, 1), max(counts.n, 1)
    if balanced:
        rows = positives + negatives
        up, down = rows / (2.0 * positives), rows / (2.0 * negatives)
    else:
        up, down = negatives / positives, 1.0
    return train.withColumn("weight", F.when(F.col("is_churn") == 1, up).otherwise(down))


def boosted_trees(**overrides) -> GBTClassifier:
    """The main model; parameters carry their usual names."""
    p = {**fixed.BOOSTED_TREES, **overrides}
    return GBTClassifier(
        featuresCol="features",
        labelCol=fixed.LABEL,
        weightCol="weight",
        maxIter=p["n_estimators"],
        maxDepth=p["max_depth"],
        stepSize=p["learning_rate"],
        subsamplingRate=p["subsample"],
        featureSubsetStrategy=str(p["colsample"]),
        minInstancesPerNode=p["min_child_weight"],
        seed=p["random_state"],
    )


def logistic_regression(max_iter: int = 1000) -> LogisticRegression:
    return LogisticRegression(labelCol=fixed.LABEL, weightCol="weight", maxIter=max_iter)


def random_forest(trees: int = 100, depth: int = 15, leaf: int = 50) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=fixed.LABEL,
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf,
        seed=42,
    )


def baseline_boosting(trees: int = 100, depth: int = 5, leaf: int = 50) -> GBTClassifier:
    return GBTClassifier(
        labelCol=fixed.LABEL,
        maxIter=trees,
        maxDepth=depth,
        stepSize=0.1,
        minInstancesPerNode=leaf,
        seed=42,
    )


def neural_net(max_iter: int = 100, hidden: Sequence[int] = tuple(HIDDEN_LAYERS)) -> Pipeline:
    """Scaled inputs into a multilayer perceptron."""
    scale = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    net = MultilayerPerceptronClassifier(
        featuresCol="scaled",
        labelCol=fixed.LABEL,
        layers=[len(fixed.FEATURES), *hidden, 2],
        maxIter=max_iter,
        blockSize=256,
        seed=42,
    )
    return Pipeline(stages=[scale, net])


def _read_trees(spark: SparkSession, path: str) -> list[tuple[np.ndarray, ...]]:
    """Per tree of a saved model: feature, threshold, left and right child, value of
    each node; a leaf is its own child. The size depends on trees and depth, not on data."""
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID",
        "nodeData.id",
        "nodeData.prediction",
        "nodeData.leftChild",
        "nodeData.rightChild",
        "nodeData.split.featureIndex",
        F.get("nodeData.split.leftCategoriesOrThreshold", 0).alias("threshold"),
    )
    trees: dict[int, list] = {}
    for row in nodes.collect():
        trees.setdefault(row.treeID, []).append(row)
    found = []
    for _, rows in sorted(trees.items()):
        rows.sort(key=lambda r: r.id)
        inner = [r.leftChild >= 0 for r in rows]
        found.append((
            np.array([r.featureIndex if i else 0 for r, i in zip(rows, inner)]),
            np.array([r.threshold if i else np.inf for r, i in zip(rows, inner)]),
            np.array([r.leftChild if i else r.id for r, i in zip(rows, inner)]),
            np.array([r.rightChild if i else r.id for r, i in zip(rows, inner)]),
            np.array([r.prediction for r in rows]),
        ))
    return found


def _margins_by_round(trees: list, weights: list[float], x: np.ndarray) -> Iterator[np.ndarray]:
    """The margin of each row after each round."""
    margin, each = np.zeros(len(x)), np.arange(len(x))
    for weight, (feature, threshold, left, right, value) in zip(weights, trees):
        at = np.zeros(len(x), int)
        while True:
            below = np.where(x[each, feature[at]] <= threshold[at], left[at], right[at])
            if (below == at).all():
                break
            at = below
        margin = margin + weight * value[at]
        yield margin


def _watching(model: Model, watched: DataFrame):
    """The model's trees, sent to the workers once, and the watched rows as numbers."""
    spark = watched.sparkSession
    path = scratch(spark, "rounds")
    model.write().overwrite().save(path)
    shared = spark.sparkContext.broadcast((_read_trees(spark, path), list(model.treeWeights)))
    features = [F.col(c).cast("double").alias(c) for c in fixed.FEATURES]
    return shared, watched.select(*features, F.col(fixed.LABEL).cast("int").alias(fixed.LABEL))


#: Equal parts of [0, 1] that scores are counted in while rounds are watched.
SCORE_BINS = 4096


def _auc_within(cells: pd.DataFrame) -> pd.DataFrame:
    """Least and greatest area a round's counts allow: pairs in one bin may go either way."""
    cells = cells.sort_values("bin")
    pos, neg = cells["pos"].to_numpy(float), cells["neg"].to_numpy(float)
    above = pos.sum() - np.cumsum(pos)
    possible = pos.sum() * neg.sum()
    sure, open_ = (neg * above).sum() / possible, (neg * pos).sum() / possible
    return pd.DataFrame({"round": [int(cells["round"].iloc[0])], "low": [sure], "high": [sure + open_]})


def auc_bounds(model: Model, watched: DataFrame) -> list[tuple[float, float]]:
    """Bounds of the area under the ROC curve on the watched rows after each round.

    A task counts the scores of its rows by round and bin and sends these counts, so what
    is shuffled depends on rounds, bins and tasks and not on the number of watched rows.
    """
    shared, rows = _watching(model, watched)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees, weights = shared.value
        held = np.zeros((2, len(trees), SCORE_BINS), dtype=np.int64)
        for batch in batches:
            y = batch[fixed.LABEL].to_numpy()
            for k, margin in enumerate(_margins_by_round(trees, weights, batch[fixed.FEATURES].to_numpy(float))):
                score = 1 / (1 + np.exp(-np.clip(2 * margin, -700, 700)))
                at = np.minimum((score * SCORE_BINS).astype(int), SCORE_BINS - 1)
                for label in (0, 1):
                    held[label, k] += np.bincount(at[y == label], minlength=SCORE_BINS)
        for k in range(len(trees)):
            at = np.flatnonzero(held[:, k].any(axis=0))
            yield pd.DataFrame({"round": k, "bin": at, "pos": held[1, k, at], "neg": held[0, k, at]})

    cells = rows.mapInPandas(count, "round int, bin int, pos bigint, neg bigint")
    summed = cells.groupBy("round", "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    found = summed.groupBy("round").applyInPandas(_auc_within, "round int, low double, high double")
    return [(r.low, r.high) for r in sorted(found.collect())]


def round_auc(model: Model, watched: DataFrame, rounds: Sequence[int] | None = None) -> list[float]:
    """Area under the ROC curve on the watched rows after each round (counted from 0), or
    after some of them; exact, ties half."""
    shared, rows = _watching(model, watched)
    wanted = set(range(model.getNumTrees) if rounds is None else rounds)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees, weights = shared.value
        for batch in batches:
            y = batch[fixed.LABEL].to_numpy()
            for k, margin in enumerate(_margins_by_round(trees, weights, batch[fixed.FEATURES].to_numpy(float))):
                if k in wanted:
                    yield pd.DataFrame({"round": k, "margin": margin, "y": y})

    margins = rows.mapInPandas(run, "round int, margin double, y int")
    ties = margins.groupBy("round", "margin").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")
    )
    running = running_sums(ties, "margin", ["pos", "neg"], ["round"])
    pairs = F.sum(F.col("neg") * (2 * (F.col("all_pos") - F.col("cum_pos")) + F.col("pos")))
    possible = 2.0 * F.max("all_pos") * F.max("all_neg")
    found = running.groupBy("round").agg((pairs / possible).alias("auc")).collect()
    return [r.auc for r in sorted(found)]


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model as it was after some rounds: its first trees, without fitting again."""
    if rounds >= model.getNumTrees:
        return model
    jvm, gateway = SparkContext._active_spark_context._jvm, SparkContext._active_spark_context._gateway
    ml = jvm.org.apache.spark.ml
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for k in range(rounds):
        trees[k] = model._java_obj.trees()[k]
        weights[k] = float(model.treeWeights[k])
    cut = ml.classification.GBTClassificationModel(
        model.uid, trees, weights, model.numFeatures, model.numClasses
    )
    return GBTClassificationModel(cut)


def _best_round(values: Sequence[float], patience: int) -> tuple[int, bool]:
    """The number of rounds with the best value, and whether ``patience`` rounds
    without a better one followed; later rounds are not looked at."""
    best = 0
    for k, value in enumerate(values):
        if value > values[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted(
    train: DataFrame, patience: int = fixed.BOOSTED_TREES["patience"], **overrides
) -> Model:
    """Fit the main model with early stopping.

    Rows for early stopping come out of the training users, so the test users stay
    unseen. Fitting goes on until the area under the ROC curve on the watched users has
    not improved for ``patience`` rounds. MLlib cannot go on with a fit, so a short fit of
    twice the patience comes first, and if it has not ended all rounds asked for follow at
    once: at most 2 * patience trees are grown twice, whatever the rows say. The best first
    rounds are kept as they are. Rounds are compared by counts of scores; of the two best
    ones the exact areas decide. Without watched users of both classes there is nothing to
    watch and all rounds are kept.
    """
    held = _held_out(VALIDATION_SHARE)
    rows = assembled(weighted(train).withColumn("validation", held))
    asked = overrides.get("n_estimators", fixed.BOOSTED_TREES["n_estimators"])
    watched = rows.where("validation")
    if watched.select(fixed.LABEL).distinct().count() < 2:
        return boosted_trees(**overrides).fit(rows)
    fitted = rows.where("not validation")
    for rounds in dict.fromkeys([min(asked, 2 * patience), asked]):
        model = boosted_trees(**{**overrides, "n_estimators": rounds}).fit(fitted)
        middle = [(low + high) / 2 for low, high in auc_bounds(model, watched)]
        best, ended = _best_round(middle, patience)
        if ended:
            break
    others = [k for k in range(min(len(middle), best + patience)) if k != best - 1]
    if others:
        # The runner-up: the best of the other rounds that were looked at.
        two = sorted([best - 1, max(others, key=lambda k: middle[k])])
        first, second = round_auc(model, watched, two)
        best = two[1] + 1 if second > first else two[0] + 1
    return first_rounds(model, best)


def fit(estimator: Estimator, train: DataFrame, balanced: bool = False) -> Model:
    return estimator.fit(assembled(weighted(train, balanced)))


def score(df: DataFrame, model: Model) -> DataFrame:
    """Add ``churn_probability``; one pass over all rows."""
    scored = model.transform(assembled(df))
    probability = vector_to_array("probability")[1]
    return scored.select(*df.columns, probability.alias("churn_probability"))


def feature_importance(spark: SparkSession, model: Model) -> DataFrame:
    """(feature, importance), one row per feature."""
    values = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(
        list(zip(fixed.FEATURES, values)), "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")


def candidates() -> dict[str, tuple[Estimator, bool]]:
    """Models to compare and whether their rows get balanced weights."""
    return {
        "Logistic Regression": (logistic_regression(), True),
        "Random Forest": (random_forest(), True),
        "Gradient Boosting": (baseline_boosting(), False),
        "Neural Network (MLP)": (neural_net(), False),
    }


def compare(train: DataFrame, test: DataFrame, fitted: dict[str, Model]) -> DataFrame:
    """(model, part, metric, value): measure each fitted model on both parts."""
    found = []
    for name, model in fitted.items():
        for part, rows in (("train", train), ("test", test)):
            scored = score(rows, model).select(fixed.LABEL, "churn_probability")
            # Stored, since the measures read the scores several times.
            measured = evaluation.metrics(stored(scored, "scored"), score="churn_probability")
            found += [(name, part, metric, value) for metric, value in measured.items()]
    spark = train.sparkSession
    return spark.createDataFrame(found, "model string, part string, metric string, value double")


def log_run(spark: SparkSession, path: str, run_id: str, values: dict[str, object]) -> None:
    """Append a run's parameters, metrics and artefact paths as (run_id, name, value)."""
    rows = [(run_id, name, str(value)) for name, value in values.items()]
    spark.createDataFrame(rows, "run_id string, name string, value string").coalesce(
        1
    ).write.mode("append").parquet(path)
