"""Small Kafka-shaped frames for tests."""

import datetime as dt

import pyarrow as pa

from vecsink.functions.avro import Field
from vecsink.functions.avro_body import encode_bodies
from vecsink.sources.kafka import KAFKA_SCHEMA

ONE = (Field("n", "long"), Field("s", "string"))
TWO = (Field("n", "long"), Field("s", "string", 0), Field("flag", "boolean", 0))
SCHEMAS = {1: ONE, 2: TWO}
ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "float": pa.float32()}


def framed(schema_id, *values, schemas=SCHEMAS):
    fields = schemas[schema_id]
    columns = [pa.array([v], ARROW[f.avro]) for f, v in zip(fields, values)]
    return b"\x00" + schema_id.to_bytes(4, "big", signed=True) + encode_bodies(fields, columns)[0].as_py()


def record(value, offset=0, partition=0, topic="t", key=b"k"):
    return (key, value, topic, partition, offset, dt.datetime(2024, 1, 1, 0, 0, 0, 123456), 0)


def kafka(spark, rows):
    return spark.createDataFrame(rows, KAFKA_SCHEMA)
