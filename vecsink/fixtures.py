"""Kafka-shaped records made from the `events` table, for queries and tests.

Every record is derived by Spark from one event, so the work grows with the
table. Two schemas are in use: events whose id is a multiple of three have the
first, the others the second with two more fields.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecsink.functions import wire
from vecsink.functions.avro import Field, record_fields
from vecsink.functions.avro_body import encode_bodies
from vecsink.operators.batching import with_position
from vecsink.sources.kafka import KAFKA_SCHEMA

V1, V2, UNKNOWN = 100001, 100002, 999999
TOPIC = "events"
PARTITIONS = 4

_V1_FIELDS = [("event_id", "long"), ("user_id", "long"), ("event_type", "string"), ("value", "double")]
_V2_MORE = [("props", "string"), ("is_error", "boolean")]


def _schema_text(fields: list[tuple[str, str]]) -> str:
    listed = [{"name": name, "type": avro} for name, avro in fields]
    return json.dumps({"type": "record", "name": "event", "namespace": "fixtures", "fields": listed})


SCHEMA_TEXTS = {V1: _schema_text(_V1_FIELDS), V2: _schema_text(_V1_FIELDS + _V2_MORE)}
SCHEMAS = {schema_id: record_fields(text) for schema_id, text in SCHEMA_TEXTS.items()}


def registry(spark: SparkSession) -> DataFrame:
    """The two schemas as registry responses, `(schema_id, response)`."""
    rows = [(schema_id, json.dumps({"schema": text})) for schema_id, text in SCHEMA_TEXTS.items()]
    return spark.createDataFrame(rows, "schema_id int, response string")


# A third schema with the types that objects of the first two do not have, and a fourth whose `props` is a number.
V3, V4 = 100003, 100004
_V3_FIELDS = [
    ("event_id", "long"),
    ("small", "int"),
    ("half", "float"),
    ("blob", "bytes"),
    ("maybe_text", ["null", "string"]),
    ("maybe_number", ["long", "null"]),
]
_V4_FIELDS = [*_V1_FIELDS, ("props", "long")]
MORE_TEXTS = {V3: _schema_text(_V3_FIELDS), V4: _schema_text(_V4_FIELDS)}
MORE_SCHEMAS = {schema_id: record_fields(text) for schema_id, text in MORE_TEXTS.items()}
# A schema that is not read: records of it are rejects.
UNREADABLE = 100009

# Schemas that agree in all but the type of `mixed`, with fields whose names look like those of other columns.
MIXED = {200001: "int", 200002: "long", 200003: "double", 200004: "string"}
_MIXED_HEAD = [("event_id", "long"), ("sold__as_is", "string"), ("sold", ["null", "long"])]
MIXED_TEXTS = {schema_id: _schema_text([*_MIXED_HEAD, ("mixed", avro)]) for schema_id, avro in MIXED.items()}
MIXED_SCHEMAS = {schema_id: record_fields(text) for schema_id, text in MIXED_TEXTS.items()}
# Beyond this whole numbers are not all doubles.
LARGE = 2**53


def wide_registry(spark: SparkSession, others: int = 20_000) -> DataFrame:
    """Responses for the two schemas among many of other topics, one clashing and one not Avro."""
    clash = json.dumps({"schema": _schema_text([("event_id", "string"), ("user_id", "boolean")])})
    other = spark.range(others).select((F.col("id") + 1).cast("int").alias("schema_id"), F.lit(clash).alias("response"))
    proto = [(UNREADABLE, json.dumps({"schema": 'syntax = "proto3"; message Event {}'}))]
    return registry(spark).union(spark.createDataFrame(proto, "schema_id int, response string")).union(other)


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a record of the third schema."""
    number = F.col("event_id")
    encode = body_encoder(MORE_SCHEMAS[V3])
    body = encode(
        "event_id",
        (number % 1000).cast("int"),
        (F.col("value") / 2).cast("float"),
        F.col("event_type").cast("binary"),
        F.when(number % 2 == 0, F.col("event_type")),
        F.when(number % 3 == 0, number),
    )
    return _framed(spark, sf_dir, F.lit(V3), body)


def clashing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with `props` as text in one schema and as its user in another."""
    own = F.when(F.col("event_id") % 3 == 0, V4).otherwise(V2)
    head = body_encoder(SCHEMAS[V1])("event_id", "user_id", "event_type", "value")
    tail = body_encoder(SCHEMAS[V2][len(_V1_FIELDS) :])("props", F.col("event_type") == "error")
    number = body_encoder(MORE_SCHEMAS[V4][len(_V1_FIELDS) :])("user_id")
    return _framed(spark, sf_dir, own, F.concat(head, F.when(own == V2, tail).otherwise(number)))


def mixed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a record in which `mixed` is an int, a long beyond 2**53, a double or a string, by `event_id % 4`."""
    number = F.col("event_id")
    head = body_encoder(MIXED_SCHEMAS[200001][:-1])(number, F.col("event_type"), F.when(number % 3 == 0, number))
    values = [(F.col("user_id") % 1000).cast("int"), number + F.lit(LARGE), F.col("value"), F.col("event_type")]
    own, body = F.lit(None).cast("int"), F.lit(None).cast("binary")
    for remainder, (schema_id, value) in enumerate(zip(MIXED, values, strict=True)):
        chosen = number % 4 == remainder
        own = F.when(chosen, schema_id).otherwise(own)
        body = F.when(chosen, F.concat(head, body_encoder(MIXED_SCHEMAS[schema_id][-1:])(value))).otherwise(body)
    return _framed(spark, sf_dir, own, body).select(*KAFKA_SCHEMA.names)


def target_class(spark: SparkSession) -> DataFrame:
    """A declared class for the events, one JSON text in column `value`.

    It differs from what is produced in two names: the schema id is declared
    with another spelling, and `is_error` is not declared.
    """
    declared = {
        "_kafka_key": "string",
        "_kafka_topic": "string",
        "_kafka_partition": "int",
        "_kafka_offset": "int",
        "_kafka_timestamp": "date",
        "_kafka_timestampType": "int",
        "_kafka_schema_id": "string",
        "event_id": "int",
        "user_id": "int",
        "event_type": "string",
        "value": "number",
        "props": "string",
    }
    properties = [{"name": name, "dataType": [kind]} for name, kind in declared.items()]
    return spark.createDataFrame([(json.dumps({"class": "Event", "properties": properties}),)], "value string")


def body_encoder(fields: tuple[Field, ...]):
    """Arrow UDF from the columns of a record to its Avro body."""

    @F.arrow_udf("binary")
    def encode(*columns: pa.Array) -> pa.Array:
        return encode_bodies(fields, list(columns))

    return encode.asNondeterministic()


def instant(zone_free: Column) -> Column:
    """A zone-free timestamp taken as UTC, whatever the session time zone."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", start, zone_free))


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn(
        "partition", (F.col("user_id") % PARTITIONS).cast("int")
    )
    return with_position(events, ["partition"], "event_id", "offset")


def _framed(spark: SparkSession, sf_dir: str, schema_id: Column, body: Column) -> DataFrame:
    return _placed(spark, sf_dir).select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        wire.frame(schema_id, body).alias("value"),
        F.lit(TOPIC).alias("topic"),
        "partition",
        "offset",
        instant(F.col("ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
        "event_id",
    )


def framed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as Kafka-shaped records."""
    schema_id = F.when(F.col("event_id") % 3 == 0, V1).otherwise(V2)
    head = body_encoder(SCHEMAS[V1])("event_id", "user_id", "event_type", "value")
    tail = body_encoder(SCHEMAS[V2][len(_V1_FIELDS) :])("props", F.col("event_type") == "error")
    body = F.concat(head, F.when(schema_id == V2, tail).otherwise(F.lit(b"")))
    return _framed(spark, sf_dir, schema_id, body)


def kafka_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return framed_events(spark, sf_dir).select(*KAFKA_SCHEMA.names)


def damaged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with four kinds of damage, by `event_id % 50`."""
    framed = framed_events(spark, sf_dir)
    value, kind = F.col("value"), F.col("event_id") % 50
    damaged = (
        F.when(kind == 0, F.lit(None).cast("binary"))
        .when(kind == 1, F.substring(value, 1, 3))
        .when(kind == 2, F.concat(F.lit(b"\x01"), F.substring(value, 2, 2**31 - 1)))
        .when(kind == 3, wire.frame(F.lit(UNKNOWN), wire.payload(value)))
        .otherwise(value)
    )
    return framed.withColumn("value", damaged).select(*KAFKA_SCHEMA.names)


def all_damages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with all seven kinds of damage, by `event_id % 50`."""
    framed = framed_events(spark, sf_dir)
    value, kind = F.col("value"), F.col("event_id") % 50
    damaged = (
        F.when(kind == 0, F.lit(None).cast("binary"))
        .when(kind == 1, F.substring(value, 1, 3))
        .when(kind == 2, F.concat(F.lit(b"\x01"), F.substring(value, 2, 2**31 - 1)))
        .when(kind == 3, wire.frame(F.lit(UNKNOWN), wire.payload(value)))
        .when(kind == 4, wire.frame(F.lit(UNREADABLE), wire.payload(value)))
        .when(kind == 5, F.substring(value, F.lit(1), F.octet_length(value) - 1))
        .otherwise(value)
    )
    topic = F.when(kind != 6, F.col("topic"))
    return framed.withColumns({"value": damaged, "topic": topic}).select(*KAFKA_SCHEMA.names)
