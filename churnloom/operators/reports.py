"""Prediction statistics, lists, pages and display columns."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions import scalars as S
from churnloom.functions.running import running_sums


def prediction_stats(scores: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    churn = F.count_if(F.col("is_churn") == 1)
    return scores.agg(
        total.alias("total_predictions"),
        churn.alias("churn_count"),
        (total - churn).alias("retain_count"),
        F.coalesce(S.ratio(churn, total), F.lit(0.0)).alias("churn_rate"),
    )


def batch_summary(scores: DataFrame, flag_above: float = 0.3) -> DataFrame:
    """Counts of one scored batch and whether its churn rate is flagged."""
    return prediction_stats(scores).withColumns(
        {
            "rate_text": S.percent_text("churn_rate"),
            "flagged": F.col("churn_rate") > F.lit(flag_above),
        }
    )


def score_histogram(scores: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width bins over [0, 1], empty ones included (``bins`` rows)."""
    counted = scores.groupBy(S.score_bin("churn_probability", bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    every = scores.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.col("bin") / bins).alias("low"),
        ((F.col("bin") + 1) / bins).alias("high"),
        S.zero_if_null("n").alias("n"),
    )


def churn_history(scores: DataFrame, size: int = fixed.CHURN_HISTORY_SIZE) -> DataFrame:
    """The newest churn predictions, by arrival."""
    churned = scores.where(F.col("is_churn") == 1)
    return churned.orderBy(F.desc("ts"), F.desc("prediction_id")).limit(size)


def churned_top(scores: DataFrame, limit: int = fixed.CHURNED_LIST_SIZE) -> DataFrame:
    """The churn predictions with the highest probability, of all there are."""
    churned = scores.where(F.col("is_churn") == 1)
    return churned.orderBy(F.desc("churn_probability"), "msno", "prediction_id").limit(limit)


def batch_top_risks(scores: DataFrame, limit: int = 8) -> DataFrame:
    return churned_top(scores, limit)


def search_ids(scores: DataFrame, text: str, regex: bool = False) -> DataFrame:
    """Churned users whose id contains a text (or matches a pattern), any case."""
    churned = scores.where(F.col("is_churn") == 1)
    if regex:
        return churned.where(F.col("msno").rlike(f"(?i){text}"))
    return churned.where(F.contains(F.lower("msno"), F.lit(text.lower())))


def format_scores(scores: DataFrame) -> DataFrame:
    return scores.withColumns(
        {
            "short_id": S.short_id("msno"),
            "probability_text": S.percent_text("churn_probability"),
        }
    )


def users_page(
    users: DataFrame,
    day: Column | date,
    page: int = 1,
    size: int = 20,
) -> DataFrame:
    """One page of a day's users in id order, with total and page count on each row.

    A page is found by running rank, since a sorted limit would carry all rows
    before it through one task; its few rows are then sorted.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    of_day = users.where(F.col("day") == (day if isinstance(day, Column) else F.lit(day)))
    ids = of_day.select("msno").distinct()
    first = (page - 1) * size
    ranked = running_sums(ids.withColumn("one", F.lit(1)), "msno", ["one"])
    shown = ranked.where(F.col("cum_one").between(first + 1, first + size)).select("msno").orderBy("msno")
    total = ids.agg(F.count(F.lit(1)).alias("n")).scalar()
    return shown.select(
        "msno",
        total.alias("total"),
        F.lit(page).cast("bigint").alias("page"),
        F.greatest(F.lit(1), F.ceil(total / F.lit(size))).alias("pages"),
    )


# --- explanations ------------------------------------------------------------


def _falling(contributions: Column, size: Callable[[Column], Column]) -> Column:
    """Sorted by falling size, then by feature name; ``sort_array`` on structs runs
    without a comparison function per pair."""
    keyed = F.transform(
        contributions,
        lambda x: F.struct(
            (-size(x)).alias("key"), x["feature"].alias("feature"), x["value"].alias("value")
        ),
    )
    return F.sort_array(keyed)


def ranked_contributions(explained: DataFrame, limit: int | None = None) -> DataFrame:
    """Contributions by falling magnitude with their share of the largest one.

    Works inside the row: a user's array has one entry per feature.
    """
    ordered = explained.withColumn(
        "contributions", _falling(F.col("contributions"), lambda x: F.abs(x["value"]))
    )
    if limit is not None:
        ordered = ordered.withColumn("contributions", F.slice("contributions", 1, limit))
    largest = F.greatest(F.abs(F.col("contributions")[0]["value"]), F.lit(0.01))
    return ordered.withColumn(
        "contributions",
        F.transform(
            "contributions",
            lambda x: F.struct(
                x["feature"].alias("feature"),
                x["value"].alias("value"),
                (F.abs(x["value"]) / largest).alias("magnitude"),
            ),
        ),
    )


def _texts(which: int) -> Column:
    pairs = [F.lit(x) for f, texts in fixed.REASON_TEXTS.items() for x in (f, texts[which])]
    return F.create_map(*pairs)


def top_reasons(explained: DataFrame, n: int = fixed.TOP_REASONS) -> DataFrame:
    """Texts of the strongest contributions towards churn; none from 0 downwards."""
    towards = F.filter("contributions", lambda x: x["value"] > 0)
    falling = _falling(towards, lambda x: x["value"])
    texts = F.when(F.col("is_churn") == 1, _texts(0)).otherwise(_texts(1))
    named = F.filter(F.transform(falling, lambda x: texts[x["feature"]]), lambda t: t.isNotNull())
    return explained.withColumn("reasons", F.slice(named, 1, n))
