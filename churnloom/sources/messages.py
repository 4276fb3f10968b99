"""Topic messages: keyed JSON records and end-of-day control records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from churnloom import fixed, schemas
from churnloom.functions import scalars as S


def encode(records: DataFrame, topic: str, key: str = "msno") -> DataFrame:
    """Records as (topic, key, value); null fields are left out of the JSON."""
    return records.select(
        F.lit(topic).alias("topic"),
        F.col(key).alias("key"),
        F.to_json(F.struct("*"), {"dateFormat": "yyyy-MM-dd"}).alias("value"),
    )


def markers(
    days: DataFrame, topics: Sequence[str] | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """An end-of-day record per day on each topic.

    With ``counts`` (day, topic, records) a marker says how many records of its day and
    topic were sent, none if they are not listed there.
    """
    topics = topics or [fixed.LOG_TOPIC, fixed.TRANSACTION_TOPIC]
    ends = days.withColumn("topic", F.explode(F.array(*[F.lit(t) for t in topics])))
    fields = [F.lit("_end_of_day"), F.lit(True), F.lit("date"), F.date_format("day", "yyyy-MM-dd")]
    if counts is not None:
        ends = ends.join(counts, ["day", "topic"], "left")
        fields += [F.lit("_rows"), S.zero_if_null("records")]
    return ends.select(
        "topic", F.lit(fixed.MARKER_KEY).alias("key"), F.to_json(F.named_struct(*fields)).alias("value")
    )


CORRUPT = "_corrupt_record"


def _parsed(messages: DataFrame) -> DataFrame:
    """The messages with the fields of their JSON value; NaN numbers and unparsable values
    read as null."""
    schema = StructType([*schemas.RECORD.fields, StructField(CORRUPT, StringType())])
    parsed = messages.withColumn("r", F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT}))
    doubles = [f.name for f in schemas.RECORD if f.dataType.typeName() == "double"]
    return parsed.select(
        *messages.columns,
        *[
            (S.number_or_null(f"r.{f.name}") if f.name in doubles else F.col(f"r.{f.name}")).alias(f.name)
            for f in schemas.RECORD
        ],
        F.col(f"r.{CORRUPT}").alias(CORRUPT),
    )


def decode(messages: DataFrame) -> DataFrame:
    """topic and the record fields of each message."""
    return _parsed(messages).select("topic", *schemas.RECORD.fieldNames())


DATA, MARKER, REJECTED = "data", "marker", "rejected"


def sorted_out(messages: DataFrame) -> DataFrame:
    """Every message with its fields, ``day``, ``kind`` (data, marker or rejected) and, if
    it is rejected, the ``reason``."""
    rows = _parsed(messages).withColumn(
        "day", F.when(is_marker(), S.day_from_text("date")).otherwise(record_day())
    )
    known = F.coalesce(F.col("topic").isin(fixed.LOG_TOPIC, fixed.TRANSACTION_TOPIC), F.lit(False))
    unread = F.col("value").isNull() | F.col(CORRUPT).isNotNull()
    reason = (
        F.when(unread, "unparsable")
        .when(~known, "unknown topic")
        .when(F.col("day").isNull(), "no day")
        .when(~is_marker() & (F.col("msno").isNull() | (F.col("msno") == "")), "no user")
    )
    rows = rows.withColumn("reason", reason).drop(CORRUPT)
    kind = F.when(F.col("reason").isNotNull(), REJECTED).when(is_marker(), MARKER).otherwise(DATA)
    return rows.withColumn("kind", kind)


def record_day() -> "F.Column":
    """Day of a record: logs carry ``date``, transactions ``transaction_date``."""
    return S.day_from_text(
        F.when(F.col("topic") == fixed.TRANSACTION_TOPIC, F.col("transaction_date")).otherwise(
            F.col("date")
        )
    )


def is_marker() -> "F.Column":
    return F.coalesce(F.col("_end_of_day"), F.lit(False))


def control_records(decoded: DataFrame) -> DataFrame:
    """(topic, day) of the end-of-day records."""
    day = S.day_from_text("date")
    return decoded.where(is_marker() & day.isNotNull()).select("topic", day.alias("day"))


def data_records(decoded: DataFrame) -> DataFrame:
    """Records of the two known topics with a day and a user."""
    known = F.col("topic").isin(fixed.LOG_TOPIC, fixed.TRANSACTION_TOPIC)
    rows = decoded.where(~is_marker() & known).withColumn("day", record_day())
    return rows.where(F.col("day").isNotNull() & F.col("msno").isNotNull() & (F.col("msno") != ""))


def log_records(data: DataFrame) -> DataFrame:
    return data.where(F.col("topic") == fixed.LOG_TOPIC).select(
        "day", "msno", "num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs"
    )


def transaction_records(data: DataFrame) -> DataFrame:
    return data.where(F.col("topic") == fixed.TRANSACTION_TOPIC).select(
        "day", "msno", "actual_amount_paid", "is_auto_renew", "is_cancel"
    )


def since(records: DataFrame, day: str, start: date = fixed.STREAM_START) -> DataFrame:
    return records.where(F.col(day) >= F.lit(start))


def stream_from_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Replay source: message files in the order they were laid out."""
    reader = spark.readStream.schema(schemas.MESSAGE).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def stream_from_kafka(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = (fixed.LOG_TOPIC, fixed.TRANSACTION_TOPIC),
    starting: str = "earliest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Topic source; needs the Kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def publish_to_kafka(messages: DataFrame, servers: str) -> None:
    """Keyed publish; equal keys keep their order inside a partition."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "kafka.acks", "1"
    ).option("kafka.linger.ms", "50").option("kafka.batch.size", "65536").save()
