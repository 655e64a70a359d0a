import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecsink.functions.avro import UnsupportedTypeError
from vecsink.functions.convert import check_field, convert_column, rfc3339_timestamp, validate_types
from vecsink.operators.objects import to_objects, to_wire


def converted(frame):
    return frame.select(*[convert_column(f).alias(f.name) for f in frame.schema.fields])


SHAPE = """s string, b boolean, i int, l bigint, d double, ad array<double>, ai array<int>, as_ array<string>,
day date, ts timestamp"""


def test_null_of_every_type(spark):
    row = converted(spark.createDataFrame([(None,) * 10], SHAPE)).first()
    assert tuple(row) == ("", False, 0, None, 0.0, [], [], [], None, None)


def test_value_of_every_type(spark):
    row = ("x", True, 7, 8, 1.5, [1.0], [2], ["a", None], dt.date(2000, 2, 1), dt.datetime(2023, 9, 1, 12))
    expected = ("x", True, 7, 8, 1.5, [1.0], [2], ["a", ""], "2000-02-01T00:00:00Z", "2023-09-01T12:00:00Z")
    assert tuple(converted(spark.createDataFrame([row], SHAPE)).first()) == expected


@pytest.mark.parametrize(
    "micros, text",
    [
        (1693569600000000, "2023-09-01T12:00:00Z"),
        (1693569600100000, "2023-09-01T12:00:00.1Z"),
        (1693569610123000, "2023-09-01T12:00:10.123Z"),
        (1693569610000001, "2023-09-01T12:00:10.000001Z"),
        (-1, "1969-12-31T23:59:59.999999Z"),
        (-62167219200000000, "0000-01-01T00:00:00Z"),
        (253402300799999999, "9999-12-31T23:59:59.999999Z"),
    ],
)
def test_rfc3339(spark, micros, text):
    frame = spark.createDataFrame([(micros,)], "m bigint").select(F.timestamp_micros("m").alias("t"))
    assert frame.select(rfc3339_timestamp(F.col("t"))).first()[0] == text


@pytest.mark.parametrize("micros", [-62167219200000001, 253402300800000000])
def test_rfc3339_refuses_other_years(spark, micros):
    frame = spark.createDataFrame([(micros,)], "m bigint").select(F.timestamp_micros("m").alias("t"))
    with pytest.raises(Exception, match="year outside 0..9999"):
        frame.select(rfc3339_timestamp(F.col("t"))).collect()


def test_rfc3339_does_not_depend_on_the_session_zone(spark):
    # 05:30 and 06:30 UTC are both 01:30 in New York on this day.
    rows = [(1699162200000000,), (1699165800000000,)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.createDataFrame(rows, "m bigint").select(F.timestamp_micros("m").alias("t"))
        got = [r[0] for r in frame.select(rfc3339_timestamp(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2023-11-05T05:30:00Z", "2023-11-05T06:30:00Z"]


@pytest.mark.parametrize(
    "kind, advice",
    [
        ("tinyint", "int"), ("smallint", "int"), ("float", "double"), ("array<float>", "array<double>"),
        ("array<bigint>", "array<int>"), ("binary", None), ("decimal(10,2)", None), ("map<string,int>", None),
        ("struct<a:int>", None), ("timestamp_ntz", None), ("array<boolean>", None),
    ],
)
def test_refused_types(kind, advice):
    given = T._parse_datatype_string(f"c {kind}")["c"].dataType
    with pytest.raises(UnsupportedTypeError) as refused:
        check_field("c", given)
    assert (f"cast it to {advice}" in str(refused.value)) if advice else ("cast it to" not in str(refused.value))


def test_refused_before_any_row_moves(spark):
    frame = spark.range(1).select(F.col("id"), F.raise_error(F.lit("ran")).cast("float").alias("f"))
    with pytest.raises(UnsupportedTypeError):
        to_objects(frame, "C", id_column="id")


def test_vector_may_be_float_or_double(spark):
    frame = spark.createDataFrame([(1, [0.5, 2.0], "x")], "k int, v array<double>, s string")
    for given in (frame, frame.withColumn("v", F.col("v").cast("array<float>"))):
        row = to_objects(given, "C", id_column="K", vector_column="V").first()
        assert (row["class"], row["id"], row["vector"], row["properties"].asDict()) == ("C", "1", [0.5, 2.0], {"s": "x"})
    with pytest.raises(UnsupportedTypeError, match="vector"):
        to_objects(frame, "C", id_column="k", vector_column="s")
    with pytest.raises(UnsupportedTypeError):
        validate_types(frame.withColumn("w", F.col("v").cast("array<float>")).schema, vector="v")


def test_mixed_type_rows(spark):
    rows = [
        (1, 2.0, "string1", dt.date(2000, 1, 1), dt.datetime(2000, 1, 1, 12)),
        (2, 3.0, "string2", dt.date(2000, 2, 1), dt.datetime(2000, 1, 2, 12)),
        (4, 5.0, "string3", dt.date(2000, 3, 1), dt.datetime(2000, 1, 3, 12)),
    ]
    frame = spark.createDataFrame(rows, "a bigint, b double, c string, d date, e timestamp")
    built = to_objects(frame, "Mixed", id_mode="random").collect()
    assert [tuple(r["properties"]) for r in built] == [
        (1, 2.0, "string1", "2000-01-01T00:00:00Z", "2000-01-01T12:00:00Z"),
        (2, 3.0, "string2", "2000-02-01T00:00:00Z", "2000-01-02T12:00:00Z"),
        (4, 5.0, "string3", "2000-03-01T00:00:00Z", "2000-01-03T12:00:00Z"),
    ]
    assert len({r["id"] for r in built}) == 3 and all(len(r["id"]) == 36 for r in built)


def test_id_and_column_faults(spark):
    frame = spark.createDataFrame([(1, "x")], "k int, s string")
    with pytest.raises(ValueError, match="not in the frame"):
        to_objects(frame, "C", id_column="missing")
    with pytest.raises(ValueError, match="ids from positions"):
        to_objects(frame, "C")
    with pytest.raises(ValueError, match="idMode"):
        to_objects(frame, "C", id_mode="other")
    with pytest.raises(ValueError, match="no column is left"):
        to_objects(frame.select("k"), "C", id_column="k")
    with pytest.raises(ValueError, match="same column"):
        to_objects(frame, "C", id_column="k", vector_column="K")


def test_row_without_id_fails_the_job(spark):
    frame = spark.createDataFrame([(None, "x")], "k int, s string")
    with pytest.raises(Exception, match="has no id"):
        to_objects(frame, "C", id_column="k").collect()


def test_wire_form(spark):
    frame = spark.createDataFrame([("1", None, 5)], "k string, s string, l bigint")
    row = to_wire(to_objects(frame, "C", id_column="k")).first()
    assert row["vector"] == [] and row["properties"] == '{"s":"","l":5}'
    again = to_wire(to_wire(to_objects(frame, "C", id_column="k"))).first()
    assert again == row
