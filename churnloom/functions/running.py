"""Exact running sums over an order that may not fit one task.

A window without (or with a coarse) partition key sorts everything in one task.
Here the rows are range-partitioned by the whole key first; each range is summed
on its own and gets the total of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnloom.session import stored


def running_sums(
    rows: DataFrame,
    order: str,
    measures: Sequence[str],
    groups: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add ``cum_<m>`` (up to and including the row) and ``all_<m>`` per group.

    ``rows`` holds one row per (groups, order): aggregate repeated keys before
    the call, which also keeps a key with a large share of the input small.
    Adaptive execution sizes the ranges unless their number is given. The number
    of a row's range is written with it, so all later steps, and steps that are
    repeated after a lost executor, see the same ranges.
    """
    groups = list(groups)
    key = [*groups, order]
    split = rows.repartitionByRange(ranges, *key) if ranges else rows.repartitionByRange(*key)
    placed = stored(split.withColumn("_range", F.spark_partition_id()), "running")
    return _many_ranges(placed, order, measures, groups)


def _up_to_row(keys: Sequence[str], order: str):
    return (
        Window.partitionBy(*keys)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _many_ranges(
    placed: DataFrame, order: str, measures: Sequence[str], groups: list[str]
) -> DataFrame:
    parts = [*groups, "_range"]
    within = placed.select(
        "*", *[F.sum(m).over(_up_to_row(parts, order)).alias(f"_in_{m}") for m in measures]
    ).alias("w")

    # One row per (group, range): at most groups + ranges rows in all.
    per_range = placed.groupBy(*parts).agg(*[F.sum(m).alias(m) for m in measures])
    earlier = (
        Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*groups)
    offsets = per_range.select(
        *parts,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"all_{m}") for m in measures],
    ).alias("o")

    same = reduce(
        lambda a, b: a & b, [F.col(f"w.{c}").eqNullSafe(F.col(f"o.{c}")) for c in parts]
    )
    kept = [c for c in placed.columns if c != "_range"]
    return within.join(offsets, same).select(
        *[f"w.{c}" for c in kept],
        *[(F.col(f"w._in_{m}") + F.col(f"o._off_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"o.all_{m}") for m in measures],
    )
