"""Exact Kolmogorov-Smirnov p-values against all orders of small samples."""

from itertools import combinations
from math import comb

import pytest
from pyspark.sql import functions as F

from churnloom.operators import drift


def by_enumeration(limit, n, m):
    hits = 0
    for places in combinations(range(n + m), n):
        taken, i, j, worst = set(places), 0, 0, 0
        for k in range(n + m):
            i, j = (i + 1, j) if k in taken else (i, j + 1)
            worst = max(worst, abs(i * m - j * n))
        hits += worst >= limit
    return hits / comb(n + m, n)


@pytest.mark.parametrize("n,m", [(1, 1), (1, 5), (2, 3), (3, 3), (4, 6), (5, 7)])
def test_every_order(spark, n, m):
    limits = list(range(0, n * m + 1))
    rows = spark.createDataFrame([(d, d / (n * m), n, m) for d in limits], "d int, stat double, n bigint, m bigint")
    got = {r.d: r.p for r in rows.select("d", drift.exact_ks_pvalue(F.col("stat"), F.col("n"), F.col("m")).alias("p")).collect()}
    for d in limits:
        assert abs(got[d] - by_enumeration(d, n, m)) < 1e-12


def test_large_samples_and_the_asymptotic_way_beyond_the_bound(spark):
    rows = spark.createDataFrame([(0.05, 4000, 5000), (0.02, 5000, 5000), (None, 3, 4)], "s double, n bigint, m bigint")
    exact = drift.exact_ks_pvalue(F.col("s"), F.col("n"), F.col("m"))
    rough = drift.exact_ks_pvalue(F.col("s"), F.col("n"), F.col("m"), up_to=1000)
    for row in rows.select("s", exact.alias("a"), rough.alias("b")).collect():
        assert (row.a is None) if row.s is None else abs(row.a - row.b) < 0.003
