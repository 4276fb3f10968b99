"""Secret scans over an incremental ledger of blobs; DataFrame operations only.

Method: every version of every path is content-addressed (SHA-256 of its text). The
ledger folder holds what was ever scanned:

``versions``  (path, blob): which paths hold which blob; one row per version seen.
``scanned``   (blob, rule_version): pairs that need no scan any more.
``findings``  (blob, kind, rule_version, first, last): spans in code points, end exclusive.

A run reads each different blob once, and only if some rule version has not seen it;
findings are joined back to all paths of their blob. A changed rule gets a new version
and is scanned alone. Rows of a run are appended with the run's number before ``scanned``
is, so a run that is cut off leaves nothing that counts: findings without a scanned
pair of the same run are ignored, and the next run scans those blobs again.

Defined results: null text counts as an empty blob; null path is a path like any other;
repeated rows are versions of their own with equal results; texts of any length are
scanned whole; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnloom.llm.common import likely
from churnloom.session import stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost, non-overlapping matches of ``pattern`` whose
    ``group`` has at least ``shortest`` characters. Fixed values with their order."""

    kind: str
    pattern: str
    group: int
    shortest: int
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGN = Rule(
    "assign",
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    2,
    8,
)
# Matches are whole runs, so asking for the length in the pattern finds the same ones as
# dropping shorter matches, without a row for each of those.
ACCESS = Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16)
HEX = Rule("hex", r"[0-9a-f]{32,}", 0, 32)
BASE = (ASSIGN, ACCESS, HEX)

_VERSIONS = "path bigint, blob string"
_SCANNED = "blob string, rule string, run string"
_FINDINGS = "blob string, kind string, rule string, first bigint, last bigint, run string"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A ledger table, empty before its first run."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], T._parse_datatype_string(schema))


def _spans(texts: DataFrame, rule: Rule) -> DataFrame:
    """(blob, kind, rule, first, last) of the matches that pass.

    Positions come from the texts between the matches: the lengths of what was before.
    A blob's matches are added up in order by a window over that blob's own rows.
    """
    at = texts.where(F.col("text").rlike(rule.pattern))
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split("text", rule.pattern, -1)
    sizes = at.select(
        "blob",
        F.transform(gaps, F.length).alias("gaps"),
        F.transform(found, F.length).alias("found"),
        F.transform(part, F.length).alias("part"),
    )
    rows = sizes.select("blob", "gaps", "part", F.posexplode("found").alias("k", "n")).select(
        "blob", "k", "n", F.get("gaps", "k").alias("gap"), F.get("part", "k").alias("part")
    )
    before = "sum(cast(gap + n as bigint)) over (partition by blob order by k)"
    return (
        rows.withColumn("last", F.expr(before))
        .where(F.col("part") >= rule.shortest)
        .select(
            "blob",
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.name).alias("rule"),
            (F.col("last") - F.col("n")).alias("first"),
            "last",
        )
    )


class Ledger:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        return _existing(self.spark, f"{self.folder}/{name}", schema)

    def _add(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("append").parquet(f"{self.folder}/{name}")

    def versions(self) -> DataFrame:
        return self._table("versions", _VERSIONS)

    def scanned(self) -> DataFrame:
        return self._table("scanned", _SCANNED)

    def findings(self) -> DataFrame:
        """Findings of completed runs."""
        found, done = self._table("findings", _FINDINGS), self.scanned()
        return found.join(done.select("run").distinct(), "run", "left_semi")

    def scan(self, docs: DataFrame, rules: Sequence[Rule] = BASE) -> None:
        """Add the versions in ``docs`` (path, text) and scan what is unseen."""
        run = uuid.uuid4().hex
        addressed = docs.select(
            F.col("path"), blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")
        )
        self._add(addressed.select("path", "blob"), "versions")
        pairs = self.scanned().where(F.col("rule").isin([r.name for r in rules]))
        seen = pairs.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        if not pairs.isEmpty():
            # Hashes first: texts of blobs that every rule has seen are not moved.
            whole = seen.where(F.size("seen") == len({r.name for r in rules}))
            new = addressed.select("blob").distinct().join(whole, "blob", "left_anti")
            hashed = addressed.withColumn("h", F.xxhash64("blob"))
            addressed = likely(hashed, "h", stored(new.select(F.xxhash64("blob").alias("h")), "new")).drop("h")
        # Equal blobs meet before they are compared with the ledger, so a text that
        # very many paths hold is one row per task.
        blobs = addressed.groupBy("blob").agg(F.first("text").alias("text"))
        unseen = blobs.join(seen, "blob", "left").withColumn(
            "todo",
            F.array_except(
                F.array(*[F.lit(r.name) for r in rules]),
                F.coalesce("seen", F.array().cast("array<string>")),
            ),
        )
        todo = stored(unseen.where(F.size("todo") > 0).select("blob", "todo", "text"), "unseen")
        spans = [_spans(todo.where(F.array_contains("todo", r.name)), r) for r in rules]
        self._add(reduce(DataFrame.union, spans).withColumn("run", F.lit(run)), "findings")
        done = todo.select("blob", F.explode("todo").alias("rule"), F.lit(run).alias("run"))
        self._add(done, "scanned")

    def by_blob(self, rules: Sequence[Rule] = BASE) -> DataFrame:
        """Blobs with findings: n_<kind>, the base spans' digest and all spans."""
        order = F.element_at(
            F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)]), F.col("kind")
        )
        found = self.findings().where(F.col("rule").isin([r.name for r in rules])).distinct()
        base = [r.kind for r in BASE]
        span = F.struct("first", order.alias("order"), "last", "kind")
        lists = found.groupBy("blob").agg(
            *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base],
            F.array_sort(F.collect_list(span)).alias("all"),
        )
        text = lambda spans: F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ","
        )
        own = F.filter("all", lambda s: s["kind"].isin(base))
        return lists.select(
            "blob", *[f"n_{k}" for k in base], F.sha2(text(own), 256).alias("base_sha256"), text("all").alias("spans")
        )

    def paths(self, versions: DataFrame, rules: Sequence[Rule] = BASE) -> DataFrame:
        """Findings joined to each of the given versions (path, blob)."""
        found = stored(self.by_blob(rules), "found")
        base = [F.coalesce(f"n_{r.kind}", F.lit(0).cast("bigint")).alias(f"n_{r.kind}") for r in BASE]
        return versions.join(found, "blob", "left").select(
            "path",
            *base,
            F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
            F.coalesce("spans", F.lit("")).alias("spans"),
        )
