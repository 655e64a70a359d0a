"""Kafka-shaped rows to parsed rows, and the rows that cannot be parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecsink.functions import wire
from vecsink.sources.kafka import check_kafka_schema

# Why a record is set aside.
NULL_VALUE = "null_value"
SHORT_VALUE = "short_value"
BAD_MAGIC = "bad_magic"
UNKNOWN_SCHEMA = "unknown_schema"
UNSUPPORTED_SCHEMA = "unsupported_schema"
BAD_PAYLOAD = "bad_payload"
NULL_ID = "null_id"


#: A column that holds a record which was set aside; null for one that was not.
REJECT = "rejected_record"
#: Its fields, beside the position that every row has.
REJECT_FIELDS = ("key", "value", "timestamp", "timestampType", "schema_id", "reject_reason")


def reject_record() -> Column:
    return F.when(F.col("reject_reason").isNotNull(), F.struct(*REJECT_FIELDS))


class RejectedRecordError(RuntimeError):
    """Raised by Spark, inside a message, when strict mode meets a reject."""


def parse_envelope(kafka: DataFrame) -> DataFrame:
    """Add `key_text`, `schema_id`, `payload`, `event_time` and `reject_reason`.

    One projection: no shuffle, no Python. Unused columns are pruned by the
    optimizer, so a scan for schema ids alone reads only `value`. Columns beyond
    the Kafka ones, such as a batch number, are kept.
    """
    check_kafka_schema(kafka)
    value = F.col("value")
    reason = (
        F.when(value.isNull(), NULL_VALUE).when(~wire.has_header(value), SHORT_VALUE).when(~wire.has_magic(value), BAD_MAGIC)
    )
    return kafka.select(
        "*",
        wire.text(F.col("key")).alias("key_text"),
        wire.schema_id(value).alias("schema_id"),
        wire.payload(value).alias("payload"),
        wire.millis(F.col("timestamp")).alias("event_time"),
        reason.alias("reject_reason"),
    )


def distinct_schema_ids(parsed: DataFrame) -> DataFrame:
    """Schema ids of the readable records."""
    return parsed.where("reject_reason IS NULL").select("schema_id").distinct()


def of_schema(parsed: DataFrame, schema_id: int) -> DataFrame:
    """Readable records of one schema id."""
    return parsed.where(F.col("reject_reason").isNull() & (F.col("schema_id") == schema_id))


def schema_statistics(parsed: DataFrame) -> DataFrame:
    """Readable records per schema id; partial sums keep a hot id cheap."""
    return (
        parsed.where("reject_reason IS NULL")
        .groupBy("schema_id")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("offset").alias("min_offset"),
            F.max("offset").alias("max_offset"),
        )
    )
