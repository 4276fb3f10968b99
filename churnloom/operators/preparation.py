"""Imputation settings, model-ready features, splits and audits."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom import fixed
from churnloom.functions import scalars as S
from churnloom.functions.running import running_sums

MODE_COLUMNS = ["city", "registered_via"]

#: Rows from which a table is dealt to all cores before models read it, and most rows of a
#: task where the cores alone would get more.
MANY_ROWS = 50_000
ROWS_OF_A_TASK = 1_000_000


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long table (feature, value, n) of the non-null values of some columns."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "feature", "value")
    known = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact interpolated median per column, nulls skipped: (feature, median).

    Works on counts per distinct value and a running count over them, so no task
    has to hold all values of a column.
    """
    ranked = running_sums(value_counts(df, columns), "value", ["n"], ["feature"])
    before = F.col("cum_n") - F.col("n")
    low, high = F.floor((F.col("all_n") + 1) / 2), F.ceil((F.col("all_n") + 1) / 2)

    def at(rank: Column) -> Column:
        return F.max(F.when((rank > before) & (rank <= F.col("cum_n")), F.col("value")))

    return ranked.groupBy("feature").agg(((at(low) + at(high)) / 2).alias("median"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the smallest among equals: (feature, mode)."""
    counts = value_counts(df, columns)
    return counts.groupBy("feature").agg(
        F.max_by("value", F.struct("n", -F.col("value"))).alias("mode")
    )


def impute_stats(df: DataFrame) -> DataFrame:
    """Fill values per feature: medians of the numeric features and age, modes of
    the categorical ones."""
    mid = medians(df, [*fixed.NUMERIC_FEATURES, "bd"]).select(
        "feature", F.lit("median").alias("stat"), F.col("median").alias("value")
    )
    most = modes(df, MODE_COLUMNS).select(
        "feature", F.lit("mode").alias("stat"), F.col("mode").alias("value")
    )
    return mid.unionAll(most)


def fit_config(df: DataFrame, base: dict | None = None) -> dict:
    """Imputation settings as a plain dict (17 values); refreshes ``base`` if given."""
    fitted = {(r.feature, r.stat): r.value for r in impute_stats(df).collect()}
    config = dict(base or {})
    config.setdefault("drop_cols", fixed.NON_FEATURES)
    config.setdefault("num_cols_fill_zero", fixed.NUMERIC_FEATURES)
    config.setdefault("gender_map", fixed.GENDER_CODES)
    config["num_cols_medians"] = {
        c: fitted[(c, "median")] for c in fixed.NUMERIC_FEATURES if (c, "median") in fitted
    }
    config["bd_median"] = fitted.get(("bd", "median"))
    for c in MODE_COLUMNS:
        value = fitted.get((c, "mode"))
        config[f"{c}_mode"] = None if value is None else int(value)
    return config


def save_config(spark: SparkSession, config: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(config, ensure_ascii=False),)], "value string").coalesce(
        1
    ).write.mode("overwrite").text(path)


def load_config(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def impute(df: DataFrame, config: dict, policy: str = "zero") -> DataFrame:
    """Model-ready features.

    ``policy`` is what a missing numeric feature becomes: ``zero`` as in training
    or ``median`` as in scoring, where an unknown user should look average.
    """
    if policy not in ("zero", "median"):
        raise ValueError("policy is zero or median")
    centre = config["num_cols_medians"] if policy == "median" else {}
    filled = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(float(centre.get(c) or 0)))
        for c in fixed.NUMERIC_FEATURES
    }
    filled["bd"] = F.coalesce(F.col("bd").cast("double"), F.lit(config["bd_median"]).cast("double"))
    for c in MODE_COLUMNS:
        filled[c] = F.coalesce(F.col(c).cast("bigint"), F.lit(config[f"{c}_mode"]).cast("bigint"))
    filled["gender"] = S.gender_code("gender").cast("bigint")
    return df.withColumns(filled)


def split_by_registration(
    df: DataFrame, cut: date = fixed.SPLIT_DATE, column: str = "registration_init_time"
) -> tuple[DataFrame, DataFrame]:
    """Registered before the cut, and from it on; unknown dates are in neither."""
    day = F.col(column)
    return df.where(day < F.lit(cut)), df.where(day >= F.lit(cut))


def feature_matrix(df: DataFrame) -> DataFrame:
    return df.select("msno", *fixed.FEATURES, fixed.LABEL)


def dealt(df: DataFrame) -> DataFrame:
    """Many users in equal parts, a multiple of the cores.

    A fit reads its rows hundreds of times and is as slow as the largest task; the files of
    a stored table are packed into fewer tasks than cores, of unequal size. Few users stay
    where they are.
    """
    rows = df.count()
    if rows < MANY_ROWS:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * math.ceil(rows / (cores * ROWS_OF_A_TASK)), "msno")


def label_rates(df: DataFrame, cut: date = fixed.SPLIT_DATE) -> DataFrame:
    """Rows and churn rate per split; ``unsplit`` are rows without a date."""
    day = F.col("registration_init_time")
    part = F.when(day < F.lit(cut), "train").when(day >= F.lit(cut), "test").otherwise("unsplit")
    counted = df.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("is_churn").alias("churned")
    )
    total = counted.agg(F.sum("row_count").alias("row_count"), F.sum("churned").alias("churned"))
    return counted.unionByName(total.withColumn("part", F.lit("all"))).select(
        "part", "row_count", S.ratio("churned", "row_count").alias("churn_rate")
    )


def class_weight(df: DataFrame) -> DataFrame:
    """Negatives per positive."""
    negative, positive = F.count_if(F.col("is_churn") == 0), F.count_if(F.col("is_churn") == 1)
    return df.agg(
        negative.alias("negatives"),
        positive.alias("positives"),
        S.ratio(negative, positive).alias("scale_pos_weight"),
    )


def null_audit(df: DataFrame) -> DataFrame:
    """Nulls left over features and label, per column and in total."""
    columns = [*fixed.FEATURES, fixed.LABEL]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns), F.lit(0))
    return counts.withColumn("all_columns", total).unpivot(
        [], [*columns, "all_columns"], "column_name", "nulls"
    )
