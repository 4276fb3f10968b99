"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_U64 = np.uint64

#: ASCII white space, the separators of the words ``[^\x20\x09-\x0D]+``.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id (bigint) and text (null as empty); all other columns are left out."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def same(left: Column, right: Column) -> Column:
    """Equality in which null equals null; still an equi-join key."""
    return left.eqNullSafe(right)


#: Words of 64 bits in the filter of ``likely``: at most so many rows are broadcast.
FILTER_WORDS = 1 << 20


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` (a 64-bit hash) is among ``wanted`` (its only column), and a
    few more: a bit for each hash, so that rows can be left out before they are shuffled.

    With very many wanted hashes more rows pass; a join afterwards decides.
    """

    def place(h: Column) -> tuple[Column, Column]:
        return F.pmod(h, F.lit(FILTER_WORDS)), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")

    word, bit = place(F.col(wanted.columns[0]))
    bits = wanted.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("_b"))
    bits = F.broadcast(bits.groupBy("_word").agg(F.bit_or("_b").alias("_bits")))
    word, bit = place(F.col(key))
    met = rows.withColumn("_word", word).join(bits, "_word")
    there = F.call_function("shiftright", "_bits", bit).bitwiseAND(F.lit(1)) == 1
    return met.where(there).select(*rows.columns)


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; bytes.split() splits at just these."""
    return text.encode("utf-8", "surrogatepass").split()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (a bijection)."""
    h = h ^ (h >> _U64(31))
    h = h * _U64(0x9E3779B97F4A7C15)
    h = h ^ (h >> _U64(29))
    h = h * _U64(0xD6E8FEB86659FD93)
    return h ^ (h >> _U64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base & (2**64 - 1), dtype=_U64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=_U64)


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbours, in linear time.

    The polynomial sum(values[i+j] * base**j) modulo 2**64 comes from differences
    of one running sum; base is odd, so dividing by base**i is a multiplication.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, dtype=_U64)
    sums = np.zeros(n + 1, dtype=_U64)
    np.cumsum(values * powers(base, n), out=sums[1:], dtype=_U64)
    inverse = powers(pow(base, -1, 2**64), n - width + 1)
    return mix((sums[width:] - sums[: n - width + 1]) * inverse)
