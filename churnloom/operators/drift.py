"""Feature drift against the training baseline: PSI and two-sample KS per day."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions import scalars as S
from churnloom.functions.running import running_sums
from churnloom.session import stored


def long_features(
    df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] = tuple(fixed.NUMERIC_FEATURES)
) -> DataFrame:
    """(keys, feature, value) with one row per known value."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot(list(keys), list(columns), "feature", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin 0..bins-1 with edge(i) <= value < edge(i + 1), the last one closed; null
    outside. The quotient alone can be off by one next to an edge."""
    width = (high - low) / bins
    guess = F.floor((value - low) / width)
    exact = (
        guess
        - (value < low + guess * width).cast("int")
        + (value >= low + (guess + 1) * width).cast("int")
    )
    inside = F.greatest(F.lit(0), F.least(exact, F.lit(bins - 1)))
    return F.when((value >= low) & (value <= high), inside)


def baseline_ranges(baseline: DataFrame) -> DataFrame:
    """(feature, low, high) in one pass; a constant feature gets half a unit on
    each side, a feature without values no row."""
    ends = [
        F.struct(
            F.lit(c).alias("feature"),
            F.min(S.number_or_null(F.col(c).cast("double"))).alias("low"),
            F.max(S.number_or_null(F.col(c).cast("double"))).alias("high"),
        )
        for c in fixed.NUMERIC_FEATURES
    ]
    rows = baseline.agg(F.array(*ends).alias("ends")).select(F.inline("ends"))
    flat = F.col("low") == F.col("high")
    return rows.where(F.col("low").isNotNull()).select(
        "feature",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )


def drift_baseline(baseline: DataFrame, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """(feature, bin, low, high, bin_low, bin_high, ref_count), zero bins included."""
    ranges = baseline_ranges(baseline)
    counts = _bin_counts(long_features(baseline), ranges, bins, "ref_count")
    width = (F.col("high") - F.col("low")) / bins
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)).cast("array<bigint>")))
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        "low",
        "high",
        (F.col("low") + F.col("bin") * width).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_high"),
        S.zero_if_null("ref_count").alias("ref_count"),
    )


def _bin_counts(
    long: DataFrame, ranges: DataFrame, bins: int, name: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Counts per (keys, feature, bin). The ranges table has one row per feature,
    at most 14, hence the broadcast."""
    placed = long.join(F.broadcast(ranges), "feature").withColumn(
        "bin", _bin_of(F.col("value"), F.col("low"), F.col("high"), bins)
    )
    return (
        placed.where(F.col("bin").isNotNull())
        .groupBy(*keys, "feature", "bin")
        .agg(F.count(F.lit(1)).alias(name))
    )


def drift_psi(
    baseline_bins: DataFrame,
    current: DataFrame,
    day: str = "event_date",
    bins: int = fixed.HISTOGRAM_BINS,
    open_ends: bool = False,
) -> DataFrame:
    """(day, feature, psi) for every day and feature with at least one value.

    ``baseline_bins`` is the (stored) result of ``drift_baseline``. Values outside
    the baseline range are not counted unless ``open_ends`` puts them into the
    end bins. The current rows are read once and shuffled as bin counts.
    """
    one_per_feature = baseline_bins.groupBy("feature").agg(
        F.first("low").alias("low"),
        F.first("high").alias("high"),
        F.transform(
            F.sort_array(F.collect_list(F.struct("bin", "ref_count"))), lambda x: x["ref_count"]
        ).alias("ref"),
    )
    # One row per feature, at most 14, hence the broadcasts.
    small = F.broadcast(one_per_feature)
    value = F.col("value")
    if open_ends:
        value = F.greatest(F.col("low"), F.least(F.col("high"), value))
    placed = long_features(current, [day]).join(small.select("feature", "low", "high"), "feature")
    counted = (
        placed.select(day, "feature", _bin_of(value, F.col("low"), F.col("high"), bins).alias("bin"))
        .groupBy(day, "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    inside = F.filter(F.collect_list(F.struct("bin", "n")), lambda x: x["bin"].isNotNull())
    per_feature = counted.groupBy(day, "feature").agg(F.map_from_entries(inside).alias("by_bin"))
    cur = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)).cast("array<bigint>"),
        lambda i: S.zero_if_null(F.try_element_at("by_bin", i)),
    )
    shares = per_feature.join(small.select("feature", "ref"), "feature").select(
        day, "feature", _shares(F.col("ref")).alias("r"), _shares(cur).alias("c")
    )
    terms = F.zip_with("r", "c", lambda r, c: (c - r) * F.ln(c / r))
    return shares.select(day, "feature", _array_sum(terms).alias("psi"))


def _array_sum(values: Column) -> Column:
    return F.aggregate(values.cast("array<double>"), F.lit(0.0), lambda acc, x: acc + x)


def _shares(counts: Column) -> Column:
    """Counts as shares that are never below epsilon."""
    eps = F.lit(fixed.PSI_EPSILON)
    total = _array_sum(counts) + eps
    return F.transform(counts, lambda n: F.greatest(n / total, eps))


def value_counts(baseline: DataFrame) -> DataFrame:
    """(feature, value, n): the baseline's distribution."""
    return long_features(baseline).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


#: Days whose running counts are held side by side in one pass.
DAYS_AT_A_TIME = 32


def drift_ks(
    baseline: DataFrame,
    current: DataFrame,
    day: str = "event_date",
    counts: DataFrame | None = None,
) -> DataFrame:
    """(day, feature, ks_stat, ref_n, cur_n) over all rows of both sides.

    ``counts`` is the stored result of ``value_counts``, if there is one.

    Both distributions only jump at values one of them has, so the gap is looked at
    there. The counts of the baseline and of each day stand side by side in one row per
    feature and value, so one running sum over the values serves all days.
    """
    ref = value_counts(baseline) if counts is None else counts
    # Calendar days.
    days = sorted(r[0] for r in current.select(day).distinct().collect() if r[0] is not None)
    found = None
    for i in range(0, len(days), DAYS_AT_A_TIME):
        some = days[i : i + DAYS_AT_A_TIME]
        part = _ks_of(ref, current if len(days) == len(some) else current.where(F.col(day).isin(some)), day, some)
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = current.schema[day].dataType.simpleString()
        return baseline.sparkSession.createDataFrame(
            [], f"{day} {kind}, feature string, ks_stat double, ref_n bigint, cur_n bigint"
        )
    return found


def _ks_of(ref: DataFrame, current: DataFrame, day: str, days: list) -> DataFrame:
    rows = ref.select("feature", "value", F.col("n").alias("r"), F.lit(None).cast(current.schema[day].dataType).alias(day))
    rows = rows.unionByName(long_features(current, [day]).withColumn("r", F.lit(0).cast("bigint")))
    names = [f"n{k}" for k in range(len(days))]
    side_by_side = rows.groupBy("feature", "value").agg(
        F.sum("r").alias("r"), *[F.count_if(F.col(day) == F.lit(d)).alias(n) for n, d in zip(names, days)]
    )
    running = running_sums(side_by_side, "value", ["r", *names], ["feature"]).where("all_r > 0")
    reference_share = F.col("cum_r") / F.col("all_r")
    gaps = running.groupBy("feature").agg(
        F.max("all_r").alias("ref_n"),
        *[
            F.struct(
                F.lit(d).alias(day),
                F.max(F.abs(reference_share - F.try_divide(F.col(f"cum_{n}"), F.col(f"all_{n}")))).alias("ks_stat"),
                F.max(f"all_{n}").alias("cur_n"),
            ).alias(n)
            for n, d in zip(names, days)
        ],
    )
    per_day = gaps.select("feature", "ref_n", F.inline(F.array(*names))).where("cur_n > 0")
    return per_day.select(day, "feature", "ks_stat", "ref_n", "cur_n")


#: Product of the two sample sizes up to which ``exact_ks_pvalue`` counts paths.
EXACT_UP_TO = 25_000_000


def _share_of_paths(limit: int, n: int, m: int) -> float:
    """Probability that a random order of n and m values keeps every |i/n - j/m| below
    limit / (n * m).

    Orders are paths through an n x m grid. ``ways[j]`` counts the paths to (i, j) that
    stay inside: a running sum over what the row before has within the row's own bounds.
    Rows are scaled, so that long paths do not overflow.
    """
    scale = 0.0
    j = np.arange(m + 1)
    ways = (j * n < limit).astype(float)
    for i in range(1, n + 1):
        inside = np.abs(i * m - j * n) < limit
        ways = np.cumsum(ways * inside) * inside
        most = ways.max()
        if most == 0.0:
            return 0.0
        ways /= most
        scale += math.log(most)
    every = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return 0.0 if ways[m] == 0.0 else math.exp(math.log(ways[m]) + scale - every)


def exact_ks_pvalue(stat: Column, n: Column, m: Column, up_to: int = EXACT_UP_TO) -> Column:
    """Two-sample Kolmogorov-Smirnov p-value: the share of orders of the pooled values
    with a gap of ``stat`` or more; the asymptotic one where n * m is above ``up_to``."""

    @F.pandas_udf("double")
    def counted(limit: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if pd.isna(d) or pd.isna(a) or pd.isna(b) or a * b == 0
                else min(1.0, max(0.0, 1.0 - _share_of_paths(int(d), int(min(a, b)), int(max(a, b)))))
                for d, a, b in zip(limit, n, m)
            ],
            dtype="float64",
        )

    n, m = n.cast("bigint"), m.cast("bigint")
    small = n * m <= up_to
    limit = F.when(small, F.rint(stat * n * m))
    return F.when(small, counted(limit, F.when(small, n), F.when(small, m))).otherwise(S.ks_pvalue(stat, n, m))


@dataclass(frozen=True)
class Reference:
    """What drift checks need of a baseline; stored, so that it is computed once."""

    bins: DataFrame
    counts: DataFrame


def reference(baseline: DataFrame) -> Reference:
    return Reference(
        stored(drift_baseline(baseline), "bins"), stored(value_counts(baseline), "values")
    )


def drift_table(
    baseline: DataFrame,
    current: DataFrame,
    day: str = "event_date",
    known: Reference | None = None,
    exact_up_to: int = 0,
) -> DataFrame:
    """(day, feature, psi, level, ks_stat, ks_pvalue, ks_drift).

    The flag uses the unrounded p-value, so a value near 0 counts as drift. P-values are
    asymptotic where the product of the two sizes is above ``exact_up_to``.
    """
    known = known or reference(baseline)
    psi = drift_psi(known.bins, current, day)
    pvalue = S.ks_pvalue("ks_stat", "ref_n", "cur_n")
    if exact_up_to:
        pvalue = exact_ks_pvalue(F.col("ks_stat"), F.col("ref_n"), F.col("cur_n"), exact_up_to)
    ks = drift_ks(baseline, current, day, known.counts).withColumn("ks_pvalue", pvalue)
    return psi.join(ks, [day, "feature"], "left").select(
        day,
        "feature",
        "psi",
        S.psi_level("psi").alias("level"),
        "ks_stat",
        "ks_pvalue",
        (F.col("ks_pvalue") < fixed.KS_ALPHA).alias("ks_drift"),
    )


def drift_summary(drift: DataFrame, day: str = "event_date") -> DataFrame:
    per_day = drift.groupBy(day).agg(
        F.max("psi").alias("max_psi"),
        F.count_if(F.col("level") == "warning").alias("n_warning"),
        F.count_if(F.col("level") == "critical").alias("n_critical"),
        F.count(F.lit(1)).alias("n_features"),
    )
    return per_day.withColumn("level", S.psi_level("max_psi"))


def drift_detail(drift: DataFrame, of_day: Column, day: str = "event_date") -> DataFrame:
    """One day by falling PSI; a day that was not checked gives a pending row."""
    known = drift.where(F.col(day) == of_day)
    asked = drift.sparkSession.range(1).select(of_day.alias("asked_day"))
    return (
        asked.join(known, F.col(day) == F.col("asked_day"), "left")
        .select(
            F.col("asked_day").alias(day),
            F.when(F.col("feature").isNull(), "pending").otherwise("done").alias("status"),
            "feature",
            "psi",
            "level",
            F.when(F.col("psi").isNotNull(), F.least(F.col("psi") / 0.4, F.lit(1.0))).alias("bar"),
            "ks_stat",
            "ks_pvalue",
            "ks_drift",
        )
        .orderBy(F.desc("psi"), "feature")
    )


def drift_overview(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("n_dates"),
        F.count_if(F.col("level") == "warning").alias("n_warning"),
        F.count_if(F.col("level") == "critical").alias("n_critical"),
    )
