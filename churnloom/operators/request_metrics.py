"""Rates, ratios, histograms and quantiles over request and score logs.

Windows come in two forms: tumbling (``every == width``) and trailing. For trailing ones
the log is counted per step and label first. A step's counts come in where its first
window is read and go out after its last one, so a running sum over these changes is the
window's sum: a difference of two prefix sums. Log rows are never multiplied, and step
rows are not copied into the windows they belong to. All sums are of whole numbers or
decimals, so differences are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from churnloom import fixed
from churnloom.functions import scalars as S
from churnloom.functions.running import running_sums

#: Steps whose windows one task adds up at a time, per label; it sets task sizes only.
STEPS_AT_A_TIME = 4096


def _step(log: DataFrame, every: int, ts: str) -> Column:
    """Number of the step a row falls in, counted from the epoch."""
    if isinstance(log.schema[ts].dataType, TimestampNTZType):
        micros = F.expr(f"({ts} - TIMESTAMP_NTZ'1970-01-01 00:00:00') div INTERVAL '0.000001' SECOND")
    else:
        micros = F.unix_micros(ts)
    size = F.lit(every * 1_000_000)
    return ((micros - F.pmod(micros, size)) / size).cast("bigint")


def _read_at(log: DataFrame, step: Column, every: int, ts: str) -> Column:
    """The time at which the window that ends with a step is read: the step's end."""
    seconds = (step + 1) * every
    if isinstance(log.schema[ts].dataType, TimestampNTZType):
        return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)
    return F.timestamp_seconds(seconds)


def stepwise(
    log: DataFrame, sums: dict[str, Column], by: Sequence[str] = (), every: int = 60, ts: str = "ts"
) -> DataFrame:
    """Sums per label and step; ``_rows`` counts the rows."""
    counted = log.groupBy(*by, _step(log, every, ts).alias("step"))
    return counted.agg(*[c.alias(n) for n, c in sums.items()], F.count(F.lit(1)).alias("_rows"))


def each_label(counted: DataFrame, labels: Sequence[str], sums: Sequence[str], overall: bool = False) -> DataFrame:
    """Step counts by each of several labels, and over all rows if ``overall``: label_of,
    label and step. The log is not read again; only its step counts are regrouped."""
    sets = [[name, "step"] for name in labels] + ([["step"]] if overall else [])
    totals = [F.sum(n).alias(n) for n in (*sums, "_rows")]
    grouped = counted.groupingSets(sets, *labels, "step").agg(
        *[F.grouping(name).alias(f"_no_{name}") for name in labels], *totals
    )
    kind, value = F.lit("all"), F.lit("all")
    for name in labels:
        here = F.col(f"_no_{name}") == 0
        kind = F.when(here, F.lit(name)).otherwise(kind)
        value = F.when(here, F.col(name).cast("string")).otherwise(value)
    return grouped.select(kind.alias("label_of"), value.alias("label"), "step", *sums, "_rows")


def trailing(counted: DataFrame, sums: Sequence[str], by: Sequence[str], span: int) -> DataFrame:
    """Sums over the last ``span`` steps at every step of which some row is within reach.

    A label is added up in pieces of ``STEPS_AT_A_TIME`` steps; a step whose windows
    reach into the next piece is in both.
    """
    size = max(STEPS_AT_A_TIME, span)
    sums = [*sums, "_rows"]
    pieces = F.array_distinct(
        F.array(F.floor(F.col("step") / size), F.floor((F.col("step") + span - 1) / size))
    )
    placed = counted.withColumn("piece", F.explode(pieces))
    first, end = F.col("piece") * size, (F.col("piece") + 1) * size
    changes = F.array(
        F.struct(F.greatest(F.col("step"), first).alias("at"), *[S.zero_if_null(n).alias(n) for n in sums]),
        F.struct((F.col("step") + span).alias("at"), *[(-S.zero_if_null(n)).alias(n) for n in sums]),
    )
    moved = placed.select(*by, "piece", F.inline(changes)).where(F.col("at") < end)
    # Rows of equal ``at`` are peers: each has the sum over all of them.
    upto = Window.partitionBy(*by, "piece").orderBy("at")
    following = F.coalesce(F.lead("at").over(upto), end)
    running = moved.select(
        *by, "at", following.alias("next"), *[F.sum(n).over(upto).alias(n) for n in sums]
    ).where((F.col("next") > F.col("at")) & (F.col("_rows") > 0))
    return running.select(
        *by, F.explode(F.sequence(F.col("at"), F.col("next") - 1)).alias("step"), *sums
    )


def windowed(
    log: DataFrame,
    sums: dict[str, Column],
    by: Sequence[str] = (),
    width: int = 60,
    every: int | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Sums per window and label; ``window_end`` is the time the window is read.

    A window holds the rows with window_end - width <= ts < window_end. ``width``
    and ``every`` are seconds and ``width`` is a multiple of ``every``; sums are of whole
    numbers or decimals.
    """
    every = every or width
    if width % every:
        raise ValueError("width has to be a multiple of every")
    counted = stepwise(log, sums, by, every, ts)
    if width > every:
        counted = trailing(counted, list(sums), by, width // every)
    return counted.select(*by, _read_at(log, F.col("step"), every, ts).alias("window_end"), *sums)


def _count() -> Column:
    return F.count(F.lit(1))


def rate(
    log: DataFrame, by: Sequence[str] = (), width: int = 60, every: int | None = None
) -> DataFrame:
    """Rows per second."""
    counted = windowed(log, {"n": _count()}, by, width, every)
    return counted.select(*by, "window_end", "n", (F.col("n") / width).alias("per_second"))


def share(
    log: DataFrame,
    condition: Column,
    by: Sequence[str] = (),
    width: int = 300,
    every: int | None = None,
) -> DataFrame:
    """Share of the rows that meet a condition."""
    counted = windowed(log, {"hits": F.count_if(condition), "n": _count()}, by, width, every)
    return counted.select(*by, "window_end", "hits", "n", S.ratio("hits", "n").alias("ratio"))


def mean(
    log: DataFrame,
    value: str,
    by: Sequence[str] = (),
    width: int = 300,
    every: int | None = None,
) -> DataFrame:
    """Mean of the values; their sum is exact."""
    counted = windowed(log, {"total": F.sum(S.exact(value)), "n": F.count(value)}, by, width, every)
    return counted.select(*by, "window_end", "n", S.ratio("total", "n").alias("mean"))


def rate_by_each(
    log: DataFrame, labels: Sequence[str], width: int = 60, every: int | None = None
) -> DataFrame:
    """Rows per second by each of several labels (label_of, label), in one pass."""
    every = every or width
    counted = each_label(stepwise(log, {}, labels, every), labels, [])
    if width > every:
        counted = trailing(counted, [], ["label_of", "label"], width // every)
    n = F.col("_rows")
    end = _read_at(log, F.col("step"), every, "ts").alias("window_end")
    return counted.select("label_of", "label", end, n.alias("n"), (n / width).alias("per_second"))


def _bucket_sums(value: str, bounds: Sequence[float]) -> dict[str, Column]:
    """Cumulative counts per bound; the last one counts all values."""
    sums = {f"b{i}": F.count_if(F.col(value) <= F.lit(b)) for i, b in enumerate(bounds)}
    return sums | {"b_inf": F.count(value)}


def bucket_counts(
    log: DataFrame,
    value: str,
    bounds: Sequence[float],
    by: Sequence[str] = (),
    width: int | None = None,
    every: int | None = None,
) -> DataFrame:
    """Cumulative counts per upper bound ``le`` (last bound +Inf), one pass.

    One conditional count per bound, turned into rows after the aggregation.
    """
    sums = _bucket_sums(value, bounds)
    if width is None:
        keys = list(by)
        counted = log.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()])
    else:
        keys = [*by, "window_end"]
        counted = windowed(log, sums, by, width, every)
    pairs = [
        F.struct(F.lit(float(b)).alias("le"), F.col(n).alias("cumulative"))
        for b, n in zip([*bounds, float("inf")], sums)
    ]
    return counted.select(*keys, F.inline(F.array(*pairs)))


def quantile_in(cumulative: Sequence[Column], bounds: Sequence[float], q: float) -> Column:
    """Quantile by linear interpolation inside the bucket that reaches rank q.

    ``cumulative`` has a count for each of ``bounds`` and, last, for all values. A rank in
    the open last bucket gives the highest finite bound; without values it is null. One
    branch per bound, so that it stays in generated code.
    """
    total = cumulative[-1]
    rank = F.lit(q) * total
    value = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        upper, low = float(bounds[i]), float(bounds[i - 1]) if i else 0.0
        below = cumulative[i - 1] if i else F.lit(0)
        inside = F.lit(low) + F.lit(upper - low) * S.ratio(rank - below, cumulative[i] - below)
        value = F.when(cumulative[i] >= rank, F.lit(upper) if i == 0 and upper <= 0 else inside).otherwise(value)
    return F.when(total > 0, value)


def bucket_quantile(buckets: DataFrame, q: float, by: Sequence[str] = ()) -> DataFrame:
    """Quantile per label from rows (le, cumulative), the last of them open."""
    counted = F.sort_array(F.collect_list(F.struct("le", "cumulative"))).alias("b")
    grouped = buckets.groupBy(*by).agg(counted)
    # ``buckets`` has a fixed number of rows per label, so each array is that short.
    known = buckets.where(F.col("le") < float("inf")).select("le").distinct().orderBy("le")
    bounds = [r.le for r in known.collect()]
    cumulative = [F.get("b", i)["cumulative"] for i in range(len(bounds) + 1)]
    total = F.element_at("b", -1)["cumulative"]
    return grouped.where(total > 0).select(
        *by, total.alias("n"), quantile_in(cumulative, bounds, q).alias("quantile")
    )


def trailing_quantiles(
    log: DataFrame,
    value: str,
    bounds: Sequence[float],
    qs: Sequence[float],
    labels: Sequence[str],
    overall: bool = False,
    width: int = 300,
    every: int | None = None,
) -> DataFrame:
    """Quantiles per trailing window by each of several labels (label_of, label, window_end,
    n, q, quantile): one pass over the log, one row of bucket counts for all quantiles."""
    every = every or width
    sums = _bucket_sums(value, bounds)
    counted = each_label(stepwise(log, sums, labels, every), labels, list(sums), overall)
    if width > every:
        counted = trailing(counted, list(sums), ["label_of", "label"], width // every)
    end = _read_at(log, F.col("step"), every, "ts").alias("window_end")
    cumulative = [F.col(c) for c in sums]
    asked = [
        F.struct(F.lit(float(q)).alias("q"), quantile_in(cumulative, bounds, q).alias("quantile"))
        for q in qs
    ]
    return counted.where("b_inf > 0").select(
        "label_of", "label", end, F.col("b_inf").alias("n"), F.inline(F.array(*asked))
    )


def in_flight(log: DataFrame, by: Sequence[str] = ("path",)) -> DataFrame:
    """Requests in progress after each start or end, per label."""
    end = F.col("ts") + F.make_dt_interval(secs=F.col("duration_seconds").cast("decimal(18,6)"))
    changes = log.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("ts").alias("at"), F.lit(1).alias("change")),
                F.struct(end.alias("at"), F.lit(-1).alias("change")),
            )
        ),
    )
    net = changes.groupBy(*by, "at").agg(F.sum("change").alias("change"))
    running = running_sums(net, "at", ["change"], by)
    return running.select(*by, "at", F.col("cum_change").alias("in_flight"))


def request_totals(log: DataFrame) -> DataFrame:
    return log.agg(
        _count().alias("requests"),
        F.count_if(F.col("status_code").startswith("5")).alias("server_errors"),
        F.count_if(F.col("path") == "/predict/").alias("single_predictions"),
        F.count_if(F.col("path") == "/predict/batch").alias("batch_predictions"),
    )


