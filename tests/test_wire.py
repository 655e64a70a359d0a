import datetime as dt

import pytest
from pyspark.sql import functions as F

from vecsink.functions import wire
from vecsink.operators import envelope
from vecsink.sources.kafka import (
    KAFKA_SCHEMA,
    KafkaShapeError,
    check_kafka_schema,
    kafka_options,
    read_kafka_stream,
)


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v binary").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("number", [0, 1, 100002, 2**31 - 1, -1, -(2**31)])
def test_schema_id_is_signed_big_endian(spark, number):
    value = b"\x00" + number.to_bytes(4, "big", signed=True) + b"rest"
    assert one(spark, value, wire.schema_id) == number
    assert one(spark, value, wire.payload) == b"rest"


@pytest.mark.parametrize("value", [None, b"", b"\x00\x00\x00"])
def test_no_schema_id_without_header(spark, value):
    assert one(spark, value, wire.schema_id) is None
    assert one(spark, value, wire.payload) is None


def test_header_alone_has_empty_payload(spark):
    assert one(spark, b"\x00\x00\x00\x00\x07", wire.payload) == b""


@pytest.mark.parametrize("number", [0, 100001, 2**31 - 1, -5])
def test_frame_round_trip(spark, number):
    row = spark.createDataFrame([(number, b"abc")], "n int, b binary")
    framed = row.select(wire.frame(F.col("n"), F.col("b")).alias("v"))
    back = framed.select(wire.schema_id(F.col("v")), wire.payload(F.col("v"))).first()
    assert tuple(back) == (number, b"abc")
    assert framed.first()["v"][:1] == b"\x00"


@pytest.mark.parametrize(
    "raw, text",
    [(b"abc", "abc"), ("é".encode(), "é"), (b"a\xffb", "a�b"), (b"\xe2\x82", "�"), (None, None), (b"", "")],
)
def test_key_text_replaces_malformed_bytes(spark, raw, text):
    assert one(spark, raw, wire.text) == text


@pytest.mark.parametrize("micros, cut", [(0, 0), (1999, 1000), (-1, 0), (-1001, -1000), (1693569610123456, 1693569610123000)])
def test_millis_cut_toward_zero(spark, micros, cut):
    frame = spark.createDataFrame([(micros,)], "m bigint").select(F.timestamp_micros("m").alias("t"))
    assert frame.select(F.unix_micros(wire.millis(F.col("t")))).first()[0] == cut


def kafka(spark, rows):
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


def test_envelope_reasons_and_null_key(spark):
    now = dt.datetime(2024, 1, 1)
    good = b"\x00\x00\x00\x00\x01body"
    rows = [
        (None, good, "t", 0, 0, now, 0),
        (b"k", None, "t", 0, 1, now, 0),
        (b"k", b"\x00\x00", "t", 0, 2, now, 0),
        (b"k", b"\x01\x00\x00\x00\x01", "t", 0, 3, now, 0),
    ]
    parsed = {r["offset"]: r for r in envelope.parse_envelope(kafka(spark, rows)).collect()}
    assert [parsed[i]["reject_reason"] for i in range(4)] == [None, "null_value", "short_value", "bad_magic"]
    assert parsed[0]["key_text"] is None and parsed[1]["key_text"] == "k"


def test_kafka_shape_is_checked(spark):
    frame = kafka(spark, [])
    assert check_kafka_schema(frame.select(*reversed(frame.columns))).columns == KAFKA_SCHEMA.names
    with pytest.raises(KafkaShapeError, match="offset is missing"):
        check_kafka_schema(frame.drop("offset"))
    with pytest.raises(KafkaShapeError, match="value is string, not binary"):
        check_kafka_schema(frame.withColumn("value", F.lit("x")))


def test_kafka_options():
    plain = kafka_options("host:9092", "clicks")
    assert plain["startingOffsets"] == "latest" and plain["failOnDataLoss"] == "false"
    assert not any("sasl" in key for key in plain)
    split = kafka_options("host:9092", "clicks", min_partitions=64, max_offsets=1000)
    assert (split["minPartitions"], split["maxOffsetsPerTrigger"]) == ("64", "1000")
    secured = kafka_options("host:9092", "clicks", "user", "secret", starting="earliest", fail_on_data_loss=True)
    assert secured["kafka.sasl.mechanism"] == "PLAIN" and secured["kafka.security.protocol"] == "SASL_SSL"
    assert "username='user' password='secret'" in secured["kafka.sasl.jaas.config"]
    assert secured["startingOffsets"] == "earliest" and secured["failOnDataLoss"] == "true"


def test_kafka_package_is_named_when_missing(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_stream(spark, kafka_options("host:9092", "clicks"))
