"""Table scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom import fixed, schemas


def _files_by_header(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """First line of each file (none if it is empty) and the files that have it.

    Only first splits are read; a header is the first line of one.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.withColumn("at", F.monotonically_increasing_id()).where("file_block_start = 0")
    first = lines.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.orderBy("file_path").collect():  # a row for each file
        found.setdefault(row.header.removeprefix("\ufeff"), []).append(unquote(row.file_path))
    return found


def _read_alike(spark: SparkSession, files: str | list[str], table: str, count_bad: bool) -> DataFrame:
    """Files that share a header."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(files)
    named = {c.strip().strip("\ufeff").lower(): c for c in raw.columns}
    declared = schemas.BRONZE[table]
    missing = [f.name for f in declared if f.name not in named]
    if missing:
        raise ValueError(f"{table}: no column {', '.join(missing)} in {files}")
    others = [c for n, c in named.items() if n not in declared.names]
    given = {f.name: F.col(f"`{named[f.name]}`") for f in declared}
    typed = {f.name: given[f.name].try_cast(f.dataType) for f in declared}
    columns = [c.alias(n) for n, c in typed.items()] + [F.col(f"`{c}`") for c in others]
    if count_bad:
        bad = [F.when(given[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in given]
        columns.append(F.array_compact(F.array(*bad)).alias(UNPARSABLE))
    return raw.select(*columns)


#: Names of the columns of a row whose text is no value of their type.
UNPARSABLE = "_unparsable"


def read_bronze(
    spark: SparkSession, path: str | list[str], table: str, count_bad: bool = False
) -> DataFrame:
    """Headered CSV: the declared columns of ``table`` by name, with their types, then
    all others as text.

    Files are read by their own header, so those of one call may have their columns in
    any order and further ones; a column that only some files have is null in the others,
    and a missing declared column fails. Further columns are kept because rows may differ
    in nothing else. A value that does not parse is null; with ``count_bad`` each row names
    such columns in ``_unparsable``, see ``unparsable``.
    """
    groups = _files_by_header(spark, path)
    parts = [_read_alike(spark, files, table, count_bad) for files in groups.values()]
    parts = parts or [_read_alike(spark, path, table, count_bad)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    return found


def unparsable(rows: DataFrame) -> DataFrame:
    """(column_name, rows): how many values of each column did not parse."""
    named = rows.select(F.explode(UNPARSABLE).alias("column_name"))
    return named.groupBy("column_name").agg(F.count(F.lit(1)).alias("rows"))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str) -> None:
    """Full replace."""
    df.write.mode("overwrite").parquet(path)


def write_by_day(df: DataFrame, path: str, day: str) -> None:
    """Replace exactly the days present in ``df``.

    The rebalance hint lets adaptive execution split a day that holds a large
    share of the rows and merge small ones, so files stay near the target size.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def publish_offline(df: DataFrame, name: str) -> None:
    """Replace the catalog table the feature store reads offline."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def ensure_feature_table(spark: SparkSession, name: str) -> None:
    """Create the day-partitioned streaming feature table if it is absent."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.FEATURE_TABLE)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, event_date DATE)"
        " USING parquet PARTITIONED BY (event_date)"
    )


def require_keys(features: DataFrame) -> DataFrame:
    """Fail the job on a missing required column (Parquet does not enforce it)."""
    checks = [
        F.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"{f.name} is required")).cast(f.dataType))
        .otherwise(F.col(f.name))
        .alias(f.name)
        for f in schemas.FEATURE_TABLE
        if not f.nullable
    ]
    required = {f.name for f in schemas.FEATURE_TABLE if not f.nullable}
    return features.select(*checks, *[c for c in features.columns if c not in required])


def append_features(features: DataFrame, path: str, dry_run: bool = False) -> None:
    """Write finished days; a retry replaces its own days instead of doubling them.

    A failed write raises, so that the day is not taken as done.
    """
    checked = require_keys(features)
    if dry_run:
        checked.write.format("noop").mode("overwrite").save()
        return
    write_by_day(checked.withColumn("event_date", F.to_date("event_timestamp")), path, "event_date")


def day_slice(features: DataFrame, day: date, columns: Sequence[str] | None = None) -> DataFrame:
    """One day; filters the partition column so that other days are not read."""
    return features.where(F.col("event_date") == F.lit(day)).select(*(columns or features.columns))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Id list from CSV: header trimmed, unquoted and lower-cased; blanks dropped."""
    raw = spark.read.option("header", True).csv(path)
    tidy = raw.toDF(*[c.strip().strip("\"'").strip().lower() for c in raw.columns])
    if "msno" not in tidy.columns:
        raise ValueError("the file needs an msno column")
    ids = tidy.select(F.trim("msno").alias("msno"))
    return ids.where(F.col("msno").isNotNull() & (F.col("msno") != ""))


def export_scores(scores: DataFrame, path: str, all_columns: bool = False) -> None:
    """CSV export: id, probability to four places, flag; or every column."""
    out = (
        scores
        if all_columns
        else scores.select(
            "msno",
            F.format_string("%.4f", "churn_probability").alias("churn_probability"),
            "is_churn",
        )
    )
    out.write.mode("overwrite").option("header", True).csv(path)


# Fixed value: a user id is 32 bytes in base64.
ID_PATTERN = "[A-Za-z0-9+/]{43}="


def sample_ids(table: DataFrame, n: int = 5, seed: int = 42, pattern: str = ID_PATTERN) -> DataFrame:
    """``n`` distinct ids in an order drawn by ``seed``, the same on every run."""
    ids = table.select(F.regexp_extract("msno", pattern, 0).alias("msno"))
    return (
        ids.where(F.col("msno") != "")
        .distinct()
        .orderBy(F.md5(F.concat("msno", F.lit(str(seed)))), "msno")
        .limit(n)
    )


def baseline_totals(features: DataFrame) -> DataFrame:
    """Stream baseline: demographics as they are, missing totals as 0."""
    totals = [c for c in fixed.NUMERIC_FEATURES if not c.startswith("avg_")]
    return features.select("msno", *fixed.DEMOGRAPHICS, *totals).fillna(0, subset=totals)
