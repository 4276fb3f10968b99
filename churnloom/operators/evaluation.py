"""Binary classification measures on a (label, score) table of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions import scalars as S
from churnloom.functions.running import running_sums

LOG_LOSS_CLIP = 2.0**-52
F1_EPSILON = 1e-9


def threshold_counts(scored: DataFrame, label: str = fixed.LABEL, score: str = "score") -> DataFrame:
    """Per distinct score t: rows at t, rows with score >= t, and all, by class. Rows without
    a score or a label say nothing and are left out."""
    y = F.col(label)
    known = scored.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & y.isNotNull())
    ties = known.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg")
    )
    running = running_sums(ties, "threshold", ["pos", "neg"])
    return running.select(
        "threshold",
        "pos",
        "neg",
        (F.col("all_pos") - F.col("cum_pos") + F.col("pos")).alias("tp"),
        (F.col("all_neg") - F.col("cum_neg") + F.col("neg")).alias("fp"),
        "all_pos",
        "all_neg",
    )


def pr_curve(counts: DataFrame) -> DataFrame:
    precision = S.ratio("tp", F.col("tp") + F.col("fp"))
    recall = S.ratio("tp", "all_pos")
    curve = counts.select("threshold", precision.alias("precision"), recall.alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return curve.withColumn("f1", 2 * p * r / (p + r + F1_EPSILON))


def roc_curve(counts: DataFrame) -> DataFrame:
    return counts.select(
        "threshold", S.ratio("fp", "all_neg").alias("fpr"), S.ratio("tp", "all_pos").alias("tpr")
    )


def auc(counts: DataFrame) -> DataFrame:
    """Rank statistic: a negative counts the positives above it, ties half."""
    above = F.col("tp") - F.col("pos")
    pairs = F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
    possible = F.max("all_pos").cast("double") * F.max("all_neg")
    return counts.agg(S.ratio(pairs, possible).alias("auc_roc"))


def average_precision(counts: DataFrame) -> DataFrame:
    """Step-wise area: recall gained at each threshold times precision there."""
    gain = S.ratio("pos", "all_pos")
    return counts.agg(F.sum(gain * S.ratio("tp", F.col("tp") + F.col("fp"))).alias("auc_pr"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """F1-optimal threshold; the lowest among equals."""
    top = F.max(F.struct("f1", (-F.col("threshold")).alias("minus_t")))
    return curve.agg(top.alias("top")).select(
        (-F.col("top.minus_t")).alias("best_threshold"), F.col("top.f1").alias("f1")
    )


def log_loss(scored: DataFrame, label: str = fixed.LABEL, score: str = "score") -> DataFrame:
    given = F.col(score).cast("double")
    p = F.when(
        given.isNotNull(),
        F.greatest(F.lit(LOG_LOSS_CLIP), F.least(F.lit(1 - LOG_LOSS_CLIP), given)),
    )
    y = F.col(label)
    return scored.agg(F.mean(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"))


def _cells(label: str, score: str, threshold: float) -> dict[str, Column]:
    y, said = F.col(label) == 1, F.col(score) >= F.lit(threshold)
    return {
        "tp": F.count_if(y & said),
        "fp": F.count_if(~y & said),
        "fn": F.count_if(y & ~said),
        "tn": F.count_if(~y & ~said),
    }


def _or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(S.ratio(top, bottom), F.lit(0.0))


def confusion(
    scored: DataFrame, threshold: float = 0.5, label: str = fixed.LABEL, score: str = "score"
) -> DataFrame:
    """The four cells, and precision, recall and F1 with 0 for 0/0."""
    cells = scored.agg(*[c.alias(n) for n, c in _cells(label, score, threshold).items()])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.withColumns(
        {
            "precision": _or_zero(tp, tp + fp),
            "recall": _or_zero(tp, tp + fn),
            "f1": _or_zero(2 * tp, 2 * tp + fp + fn),
        }
    )


def class_report(
    scored: DataFrame, threshold: float = 0.5, label: str = fixed.LABEL, score: str = "score"
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and means."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def line(right: Column, wrong_said: Column, missed: Column) -> list[Column]:
        return [
            _or_zero(right, right + wrong_said),
            _or_zero(right, right + missed),
            _or_zero(2 * right, 2 * right + wrong_said + missed),
            right + missed,
        ]

    stay, churn = line(tn, fn, fp), line(tp, fp, fn)
    accuracy = _or_zero(tp + tn, n)
    macro = [(a + b) / 2 for a, b in zip(stay[:3], churn[:3])]
    weighted = [_or_zero(a * stay[3] + b * churn[3], n) for a, b in zip(stay[:3], churn[:3])]
    lines = {
        "0": stay,
        "1": churn,
        "accuracy": [accuracy, accuracy, accuracy, n],
        "macro avg": [*macro, n],
        "weighted avg": [*weighted, n],
    }
    structs = [
        F.struct(
            F.lit(name).alias("line"),
            *[c.cast("double").alias(m) for m, c in zip(("precision", "recall", "f1"), values)],
            values[3].alias("support"),
        )
        for name, values in lines.items()
    ]
    return confusion(scored, threshold, label, score).select(F.inline(F.array(*structs)))


def metrics(scored: DataFrame, label: str = fixed.LABEL, score: str = "score") -> dict[str, float]:
    """All headline measures of one scored table as a small dict."""
    counts = threshold_counts(scored, label, score)
    curve = pr_curve(counts)
    frames = [
        auc(counts),
        average_precision(counts),
        log_loss(scored, label, score),
        confusion(scored, 0.5, label, score).select("f1", "precision", "recall"),
        best_threshold(curve).select("best_threshold"),
    ]
    found: dict[str, float] = {}
    for frame in frames:
        found.update(frame.first().asDict())
    return found
