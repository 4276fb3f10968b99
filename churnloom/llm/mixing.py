"""Mixing sources to target weights by Poisson replication; DataFrame operations only.

Method: source s holds n_s documents; its share of the output shall be w_s, so that its
mean repetition rate is w_s * total / n_s. Each document gets a number of copies drawn
from the Poisson distribution with that mean: the distribution is inverted at a uniform
number made from a seed and the document's id, so a repeated task draws the same. Each
document is exploded by its count and the copies are put in the order of a seeded hash.

Weights default to n_s ** temperature, normalised; 1 keeps the sources' shares.

Defined results: null source is a source of its own; rows without doc_id are told apart
by the hash of their text; null text is a value like any other; repeated rows draw the
same number each; a source with weight zero or not named in given weights gets no copies;
an empty table gives an empty table; extra columns are kept whatever their names, but
``copies`` and ``shuffled`` put their own ``_copy`` and ``_order`` in place of such columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom.llm.common import same
from churnloom.session import stored

SEED = 20240601
TEMPERATURE = 0.5
#: Sources whose table is broadcast at most; with more, the join shuffles.
BROADCAST_SOURCES = 20_000
#: Means beyond this are drawn as a sum of equal Poisson numbers, which is Poisson too.
LARGEST_RATE = 64


def _unit(*parts: Column) -> Column:
    """Uniform in [0, 1): 52 bits of a hash of the parts."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None,
          temperature: float = TEMPERATURE, total: int | None = None) -> DataFrame:
    """(_source, _rate, _pieces): mean copies per document of each source, counted over
    all data, and the number of equal parts it is drawn in."""
    counts = stored(docs.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("_n")), "sources")
    if weights is None:
        counts = counts.withColumn("_w", F.pow("_n", F.lit(temperature)))
    else:
        spark = docs.sparkSession
        given = spark.createDataFrame([*weights.items()], "_s string, _w double")
        counts = counts.join(F.broadcast(given), same(counts["_source"], given["_s"]), "left").drop("_s")
    whole, n = counts.agg(F.sum("_w"), F.sum("_n")).first()
    wanted = float(n or 0 if total is None else total)
    rate = F.col("_w") / F.lit(whole or 1.0) * wanted / F.col("_n")
    rate = F.coalesce(rate, F.lit(0.0))
    pieces = F.greatest(F.ceil(rate / LARGEST_RATE), F.lit(1)).cast("int")
    return counts.select("_source", rate.alias("_rate"), pieces.alias("_pieces"))


def thresholds(rate: Column) -> Column:
    """P(copies <= 0), P(copies <= 1), ... up to where nothing is left to draw.

    12 standard deviations and 20 beyond the mean less than 2**-53 is left.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    steps = F.sequence(F.lit(0), last)
    zero = F.struct(F.lit(0.0).alias("logs"), F.array().cast("array<double>").alias("terms"))

    def step(acc: Column, k: Column) -> Column:
        logs = acc["logs"] + F.when(k > 0, F.log(k.cast("double"))).otherwise(F.lit(0.0))
        term = F.exp(k * F.log(rate) - rate - logs)
        sofar = F.when(k > 0, F.element_at(acc["terms"], -1)).otherwise(F.lit(0.0))
        return F.struct(logs.alias("logs"), F.concat(acc["terms"], F.array(sofar + term)).alias("terms"))

    return F.when(rate > 0, F.aggregate(steps, zero, step)["terms"]).otherwise(F.array(F.lit(1.0)))


def _copies(docs: DataFrame, weights: dict[str | None, float] | None = None,
            temperature: float = TEMPERATURE, seed: int = SEED, total: int | None = None) -> DataFrame:
    """``row`` (a struct of the columns of ``docs``) for each copy, ``copy`` (different for
    each copy, from zero on while the rate is drawn in one piece) and ``order``."""
    steps = rates(docs, weights, temperature, total).withColumn(
        "cdf", thresholds(F.col("_rate") / F.col("_pieces"))
    )
    steps = stored(steps.where("_rate > 0").select(
        F.col("_source").alias("of"), F.col("_pieces").alias("pieces"), "cdf"), "rates")
    if steps.count() <= BROADCAST_SOURCES:
        steps = F.broadcast(steps)
    # Without an id the text stands for the row, or all such rows would share one draw.
    text = F.concat(F.lit("-"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("source").alias("source"),
        F.coalesce(F.col("doc_id").cast("string"), text).alias("key"),
    )
    joined = rows.join(steps, same(rows["source"], steps["of"]))
    drawn = _unit(F.lit(str(seed)), F.col("key"), F.col("piece").cast("string"))
    counted = (
        joined.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .withColumn("drawn", drawn)
        .withColumn("number", F.size(F.filter("cdf", lambda c: c <= F.col("drawn"))))
        .where("number > 0")
    )
    each = F.explode(F.transform(F.sequence(F.lit(0), F.col("number") - 1), lambda k: F.col("piece") * 1024 + k))
    out = counted.select("row", "key", each.alias("copy"))
    order = F.md5(F.concat_ws("|", F.lit(f"{seed}:order"), "key", F.col("copy").cast("string")))
    return out.select("row", "copy", order.alias("order"))


def _numbered(docs: DataFrame, drawn: DataFrame) -> DataFrame:
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("_copy", "_order")]
    return drawn.select(*kept, F.col("copy").alias("_copy"), F.col("order").alias("_order"))


def copies(docs: DataFrame, weights: dict[str | None, float] | None = None, **options) -> DataFrame:
    """The rows of ``docs`` repeated, with ``_copy`` and ``_order``."""
    return _numbered(docs, _copies(docs, weights, **options))


def _in_order(docs: DataFrame, **options) -> DataFrame:
    return _copies(docs, **options).repartitionByRange("order").sortWithinPartitions("order")


def shuffled(docs: DataFrame, **options) -> DataFrame:
    """Copies in global order, with ``_copy`` and ``_order``: ranges of a random key,
    sorted within."""
    return _numbered(docs, _in_order(docs, **options))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """Copies in global order, with the columns of ``docs``."""
    return _in_order(docs, **options).select("row.*")
