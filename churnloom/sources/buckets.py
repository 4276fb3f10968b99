"""Newest row per key in hash buckets, with copy on write.

``rows/version=V/bucket=B``   the rows of a bucket as version V wrote them
``manifest/version=V``        for every bucket, the version that holds its rows

A write merges only the buckets its keys fall into and points to the others where they
are; a lookup reads only the buckets of its keys. A version that is written again (a
retry) replaces what its first try left, and a version without a complete manifest does
not exist. Versions no reader needs are removed by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnloom.sources import files

BUCKETS = 64


class BucketTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        order: str,
        key: str = "msno",
        buckets: int = BUCKETS,
    ):
        """Of the rows of a key the one with the greatest ``order`` is the newest. The
        number of buckets is fixed with the first write; it should leave some ten thousand
        keys in each."""
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.order, self.key, self.buckets = order, key, buckets

    # --- versions ------------------------------------------------------------
    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        found = sorted(map(int, files.partition_values(self.spark, f"{self.root}/manifest", "version")))
        return [v for v in found if files.complete(self.spark, f"{self.root}/manifest/version={v}")]

    def manifest(self, version: int) -> dict[int, int]:
        """The version that holds each bucket's rows; a bucket without rows is missing."""
        rows = self.spark.read.schema("bucket int, version bigint, buckets int").parquet(
            f"{self.root}/manifest/version={version}"
        )
        found = rows.collect()  # one row for each bucket
        if found:
            self.buckets = found[0].buckets
        return {r.bucket: r.version for r in found if r.bucket is not None}

    # --- reads -----------------------------------------------------------------
    def bucket_of(self, key: str | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(key or self.key)), F.lit(self.buckets)).cast("int")

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """Buckets that hold some of the keys: at most as many as there are."""
        return [r[0] for r in keys.select(self.bucket_of()).distinct().collect()]

    def paths(self, version: int, wanted: list[int] | None = None) -> list[str]:
        held = self.manifest(version)
        return [
            f"{self.root}/rows/version={v}/bucket={b}"
            for b, v in sorted(held.items())
            if wanted is None or b in wanted
        ]

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, version: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """Newest rows at a version (the last one); of the buckets of ``keys`` if given,
        so more rows than keys."""
        if version is None:
            known = self.versions()
            if not known:
                return self._rows([])
            version = known[-1]
        if keys is None:
            return self._rows(self.paths(version))
        self.manifest(version)
        return self._rows(self.paths(version, self.buckets_of(keys)))

    # --- writes ----------------------------------------------------------------
    def write(self, fresh: DataFrame, version: int, base: int | None = None) -> list[int]:
        """Merge rows into version ``base`` as ``version``; returns the buckets rewritten."""
        held = self.manifest(base) if base is not None else {}
        touched = self.buckets_of(fresh)
        old = self._rows(self.paths(base, touched)) if base is not None else None
        columns = self.schema.fieldNames()
        merged = fresh.select(*columns)
        if old is not None:
            merged = merged.unionByName(old.select(*columns))
        others = [c for c in columns if c not in (self.key, self.order)]
        newest = merged.groupBy(self.key).agg(F.max(F.struct(self.order, *others)).alias("row"))
        newest = newest.select(self.key, "row.*").withColumn("bucket", self.bucket_of())
        newest.repartition(len(touched) or 1, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.root}/rows/version={version}"
        )
        held |= dict.fromkeys(touched, version)
        listed = [(b, v, self.buckets) for b, v in held.items()] or [(None, None, self.buckets)]
        self.spark.createDataFrame(listed, "bucket int, version bigint, buckets int").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/manifest/version={version}")
        return touched

    def clean(self, keep: int = 2) -> None:
        """Remove all that the newest ``keep`` versions do not point to."""
        known = self.versions()
        kept = known[-keep:]
        if not kept:
            return
        needed = {item for v in kept for item in self.manifest(v).items()}
        for v in known[:-keep]:
            files.remove(self.spark, f"{self.root}/manifest/version={v}")
        for v in map(int, files.partition_values(self.spark, f"{self.root}/rows", "version")):
            if v > kept[-1]:
                continue  # being written
            folder = f"{self.root}/rows/version={v}"
            buckets = list(map(int, files.partition_values(self.spark, folder, "bucket")))
            used = [b for b in buckets if (b, v) in needed]
            if not used:
                files.remove(self.spark, folder)
                continue
            for b in set(buckets) - set(used):
                files.remove(self.spark, f"{folder}/bucket={b}")
