"""Declared schemas, so that no scan needs an inference pass."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
    # Sums of money and seconds, see functions.scalars.
    "exact": T.DecimalType(38, 9),
}


def columns(text: str) -> T.StructType:
    """Schema from "name type, ..."; unlike DDL parsing it needs no session.

    A type followed by ``!`` is required.
    """
    fields = [part.split() for part in text.split(",")]
    return T.StructType(
        [T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")) for name, kind in fields]
    )


MEMBERS = columns(
    "msno string, city int, bd int, gender string, registered_via int, registration_init_time int"
)

TRANSACTIONS = columns(
    "msno string, transaction_date int, membership_expire_date int, actual_amount_paid double,"
    " plan_list_price double, is_auto_renew int, is_cancel int"
)

USER_LOGS = columns(
    "msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int,"
    " num_unq int, total_secs double"
)

TRAIN = columns("msno string, is_churn int")

BRONZE = {
    "members": MEMBERS,
    "transactions": TRANSACTIONS,
    "user_logs": USER_LOGS,
    "train": TRAIN,
}

# One topic message: what a Kafka source gives after casting key and value.
MESSAGE = columns("topic string, key string, value string")

# Union of the record fields of both topics plus the end-of-day control record, which says
# how many records of its day and topic were sent.
RECORD = columns(
    "_end_of_day boolean, _rows bigint, msno string, date string, transaction_date string,"
    " num_25 bigint, num_50 bigint, num_75 bigint, num_985 bigint, num_100 bigint, num_unq bigint,"
    " total_secs double, actual_amount_paid double, plan_list_price double,"
    " is_auto_renew bigint, is_cancel bigint"
)

# Streaming feature table. ``event_timestamp`` is the UTC start of the day, kept
# zone-free so that it reads the same under every session time zone.
FEATURE_TABLE = columns(
    "msno string!, event_timestamp timestamp_ntz!,"
    " city bigint, bd bigint, gender string, registered_via bigint,"
    " total_transactions bigint, total_amount_paid double, avg_amount_paid double,"
    " auto_renew_count bigint, cancel_count bigint, total_log_days bigint,"
    " total_secs double, avg_daily_secs double, total_num_25 bigint, total_num_50 bigint,"
    " total_num_75 bigint, total_num_985 bigint, total_num_100 bigint, total_num_unq bigint"
)

SCORE = columns(
    "msno string, churn_probability double, is_churn int, member_found boolean,"
    " reasons array<string>, feature_timestamp string"
)
