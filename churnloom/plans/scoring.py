"""Training and scoring jobs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions import scalars as S
from churnloom.operators import evaluation, explanation, lookup, models, preparation, reports
from churnloom.session import stored
from churnloom.sources import tables


@dataclass
class Artefacts:
    """A trained model with what scoring needs besides it."""

    model: GBTClassificationModel
    config: dict
    features: list[str]
    path: str
    run_id: str
    metrics: dict[str, float]


def train(
    spark: SparkSession,
    gold: DataFrame,
    path: str,
    cut: date = fixed.SPLIT_DATE,
    fit_on_train_only: bool = False,
    runs: str | None = None,
    patience: int = fixed.BOOSTED_TREES["patience"],
    **parameters,
) -> Artefacts:
    """Prepare, split out of time, fit, evaluate on the later users, save.

    The imputation statistics come from the whole table unless
    ``fit_on_train_only`` is set.
    """
    early, _ = preparation.split_by_registration(gold, cut)
    config = preparation.fit_config(early if fit_on_train_only else gold)
    ready = preparation.impute(gold, config, "zero")
    train_rows, test_rows = preparation.split_by_registration(ready, cut)
    train_rows, test_rows = (preparation.dealt(preparation.feature_matrix(p)) for p in (train_rows, test_rows))
    model = models.fit_boosted(train_rows, patience, **parameters)
    scored = models.score(test_rows, model)
    # Stored, since the measures read the scores several times.
    scored = stored(scored.select(fixed.LABEL, "churn_probability"), "scored")
    measured = evaluation.metrics(scored, score="churn_probability")

    run_id = uuid.uuid4().hex
    model.write().overwrite().save(f"{path}/model")
    preparation.save_config(
        spark, {**config, "feature_cols": fixed.FEATURES, "run_id": run_id}, f"{path}/config"
    )
    if runs:
        kept = {"patience": patience, "trees_kept": model.getNumTrees, "artefacts": path}
        models.log_run(spark, runs, run_id, {**fixed.BOOSTED_TREES, **parameters, **measured, **kept})
    return Artefacts(model, config, list(fixed.FEATURES), path, run_id, measured)


def load(spark: SparkSession, path: str) -> Artefacts:
    model = GBTClassificationModel.load(f"{path}/model")
    config = preparation.load_config(spark, f"{path}/config")
    return Artefacts(model, config, config["feature_cols"], path, config["run_id"], {})


def prepared(
    requests: DataFrame, latest: DataFrame, artefacts: Artefacts, seen: DataFrame | None = None
) -> DataFrame:
    """Model-ready rows of the ids, dealt to all cores.

    An id list is a small file, so that one or two tasks read all of it; a row's trees cost
    far more than moving it.
    """
    found = lookup.lookup(requests, latest, seen).hint("rebalance")
    return preparation.impute(found, artefacts.config, "median")


def score_batch(
    requests: DataFrame,
    latest: DataFrame,
    artefacts: Artefacts,
    threshold: float = fixed.CHURN_THRESHOLD,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Score any number of ids in one job; unknown ids as an average user."""
    scored = models.score(prepared(requests, latest, artefacts, seen), artefacts.model)
    return scored.withColumn("is_churn", S.churn_flag("churn_probability", threshold))


def batch_response(scored: DataFrame) -> DataFrame:
    return scored.select(
        "msno",
        "churn_probability",
        "is_churn",
        "member_found",
        F.array().cast("array<string>").alias("reasons"),
        F.lit(None).cast("string").alias("feature_timestamp"),
    )


def score_users(
    requests: DataFrame,
    latest: DataFrame,
    seen: DataFrame,
    artefacts: Artefacts,
    threshold: float = fixed.CHURN_THRESHOLD,
) -> DataFrame:
    """As ``score_batch``, with the top reasons and the day of the features."""
    scored = score_batch(requests, latest, artefacts, threshold, seen)
    keep = ["msno", "churn_probability", "is_churn", "member_found", "feature_date"]
    explained = explanation.explain(scored, artefacts.model, f"{artefacts.path}/model", keep)
    return reports.top_reasons(explained).select(
        "msno",
        "churn_probability",
        "is_churn",
        "member_found",
        "reasons",
        F.date_format("feature_date", "yyyy-MM-dd").alias("feature_timestamp"),
    )


def explain_users(requests: DataFrame, latest: DataFrame, artefacts: Artefacts) -> DataFrame:
    """All contributions per user by falling magnitude, and the base value."""
    ready = prepared(requests, latest, artefacts)
    explained = explanation.explain(ready, artefacts.model, f"{artefacts.path}/model")
    return reports.ranked_contributions(explained)


def append_scores(
    scores: DataFrame, path: str, run_id: str, event_time: str | None = None
) -> None:
    """Score log: one row per prediction with the given event time, else now.

    A run that is repeated under its id replaces its own rows.
    """
    rows = scores.select(
        "msno",
        "churn_probability",
        "is_churn",
        S.event_time_or_now(F.lit(event_time).cast("string")).alias("predicted_at"),
        F.lit(run_id).alias("run_id"),
    )
    tables.write_by_day(rows, path, "run_id")
