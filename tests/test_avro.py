import json
import math
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from vecsink.functions.avro import (
    Field,
    SchemaConflictError,
    UnsupportedTypeError,
    avro_to_spark,
    presence,
    record_fields,
    superset,
    superset_type,
)
from vecsink.functions.avro_body import OK, decode_bodies, encode_bodies


def text(*fields):
    return json.dumps({"type": "record", "name": "r", "fields": [{"name": n, "type": t} for n, t in fields]})


def test_primitive_types():
    kinds = ["int", "long", "float", "double", "boolean", "string", "bytes"]
    assert [avro_to_spark(k).simpleString() for k in kinds] == [
        "int", "bigint", "float", "double", "boolean", "string", "binary"]


@pytest.mark.parametrize(
    "declared",
    ["null", {"type": "enum", "name": "e", "symbols": ["a"]}, {"type": "array", "items": "int"},
     {"type": "map", "values": "int"}, {"type": "fixed", "name": "f", "size": 4},
     {"type": "record", "name": "n", "fields": []}, ["int", "string"], ["null", "int", "string"], ["null"]],
)
def test_other_types_are_refused(declared):
    with pytest.raises(UnsupportedTypeError):
        record_fields(text(("a", declared)))


def test_nullable_unions_and_logical_types():
    fields = record_fields(
        text(("a", ["null", "int"]), ("b", ["string", "null"]), ("c", {"type": "long", "logicalType": "timestamp-millis"}))
    )
    assert fields == (Field("a", "int", 0), Field("b", "string", 1), Field("c", "long", None))


def test_clickstream_record():
    names = [("user_id", "int"), ("username", "string"), ("registered_at", "long"), ("first_name", "string"),
             ("last_name", "string"), ("city", "string"), ("level", "string")]
    shape = superset_type({1: record_fields(text(*names))})
    assert shape.simpleString() == (
        "struct<user_id:int,username:string,registered_at:bigint,first_name:string,last_name:string,city:string,level:string>"
    )


def test_top_level_must_be_a_record():
    with pytest.raises(UnsupportedTypeError):
        record_fields('"int"')
    with pytest.raises(SchemaConflictError):
        record_fields("{not json")


def test_superset_widens_or_refuses():
    a, b = (Field("x", "int"), Field("y", "string")), (Field("x", "long"), Field("z", "double"))
    assert superset({1: a, 2: b}) == {"x": "long", "y": "string", "z": "double"}
    for other in (Field("x", "double"), Field("y", "int")):
        with pytest.raises(SchemaConflictError):
            superset({1: a, 2: (other,)})
    with pytest.raises(SchemaConflictError):
        superset({1: a, 2: (Field("X", "int"),)})
    assert presence({1: a, 2: b}) == {"x": {1, 2}, "y": {1}, "z": {2}}
    assert superset_type({}) == T.StructType([])


FIELDS = (
    Field("i", "int"),
    Field("l", "long"),
    Field("f", "float"),
    Field("d", "double"),
    Field("b", "boolean"),
    Field("s", "string"),
    Field("raw", "bytes"),
    Field("ni", "int", 0),
    Field("ns", "string", 1),
    Field("nd", "double", 0),
)
ARROW = [pa.int32(), pa.int64(), pa.float32(), pa.float64(), pa.bool_(), pa.string(), pa.binary(), pa.int32(), pa.string(),
         pa.float64()]
WANTED = {f.name: f.avro for f in FIELDS}
ROW = st.tuples(
    st.integers(-(2**31), 2**31 - 1),
    st.integers(-(2**63), 2**63 - 1),
    st.floats(width=32, allow_nan=False),
    st.floats(allow_nan=False),
    st.booleans(),
    st.text(max_size=200),
    st.binary(max_size=200),
    st.none() | st.integers(-(2**31), 2**31 - 1),
    st.none() | st.text(max_size=20),
    st.none() | st.floats(allow_nan=False),
)


def encode(rows):
    columns = [pa.array([r[i] for r in rows], ARROW[i]) for i in range(len(FIELDS))]
    return encode_bodies(FIELDS, columns)


def plain(decoded):
    out = []
    for row in decoded.to_pylist():
        for name in ("s", "ns"):
            row[name] = None if row[name] is None else row[name].decode()
        out.append(tuple(row.values()))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=20))
def test_round_trip(rows):
    bodies = encode(rows)
    decoded = decode_bodies(pa.array([7] * len(rows), pa.int32()), bodies, {7: FIELDS}, WANTED)
    assert plain(decoded) == [(*r, True) for r in rows]


@settings(max_examples=60, deadline=None)
@given(ROW, st.data())
def test_any_cut_is_a_bad_payload(row, data):
    body = encode([row])[0].as_py()
    cut = data.draw(st.integers(0, len(body) - 1))
    decoded = decode_bodies(pa.array([7], pa.int32()), pa.array([body[:cut]], pa.binary()), {7: FIELDS}, WANTED)
    assert decoded.to_pylist()[0][OK] is False
    assert all(v is None for k, v in decoded.to_pylist()[0].items() if k != OK)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=20))
def test_random_bytes_never_break_a_task(bodies):
    decoded = decode_bodies(pa.array([7] * len(bodies), pa.int32()), pa.array(bodies, pa.binary()), {7: FIELDS}, WANTED)
    assert len(decoded) == len(bodies)


def test_mixed_batch_slices_nulls_and_unknown_ids():
    one, two = (Field("a", "long"), Field("s", "string")), (Field("s", "string"), Field("b", "double"))
    b1 = encode_bodies(one, [pa.array([5], pa.int64()), pa.array(["x"])])[0].as_py()
    b2 = encode_bodies(two, [pa.array(["yy"]), pa.array([2.5])])[0].as_py()
    bodies = pa.array([b"skip", b1, None, b2, b1 + b"tail", b2, b1], pa.binary()).slice(1)
    ids = pa.array([0, 1, 1, 2, 1, 3, None], pa.int32()).slice(1)
    decoded = decode_bodies(ids, bodies, {1: one, 2: two}, {"a": "long", "s": "string", "b": "double"})
    assert [tuple(r.values()) for r in decoded.to_pylist()] == [
        (5, b"x", None, True),
        (None, None, None, False),
        (None, b"yy", 2.5, True),
        (5, b"x", None, True),
        (None, None, None, False),
        (None, None, None, False),
    ]


def test_wanted_fields_only_and_widening():
    one, two = (Field("n", "int"), Field("s", "string")), (Field("n", "double"),)
    b1 = encode_bodies(one, [pa.array([-3], pa.int32()), pa.array(["x"])])[0].as_py()
    b2 = struct.pack("<d", 0.5)
    decoded = decode_bodies(pa.array([1, 2], pa.int32()), pa.array([b1, b2]), {1: one, 2: two}, {"n": "double"})
    assert decoded.to_pylist() == [{"n": -3.0, OK: True}, {"n": 0.5, OK: True}]


def test_special_doubles():
    values = [math.inf, -math.inf, -0.0, 5e-324]
    bodies = encode_bodies((Field("d", "double"),), [pa.array([*values, math.nan])])
    decoded = decode_bodies(pa.array([1] * 5, pa.int32()), bodies, {1: (Field("d", "double"),)}, {"d": "double"})
    got = decoded.field("d").to_numpy(zero_copy_only=False)
    assert list(got[:4]) == values and np.signbit(got[2]) and math.isnan(got[4])


def test_overlong_varint_and_bad_branch_and_negative_length():
    field_sets = [(Field("l", "long"),), (Field("l", "long", 0),), (Field("s", "string"),)]
    damaged = [b"\xff" * 11, b"\x04\x02", b"\x01"]
    for fields, body in zip(field_sets, damaged):
        decoded = decode_bodies(pa.array([1], pa.int32()), pa.array([body]), {1: fields}, {fields[0].name: fields[0].avro})
        assert decoded.to_pylist()[0][OK] is False


def test_empty_batch():
    decoded = decode_bodies(pa.array([], pa.int32()), pa.array([], pa.binary()), {7: FIELDS}, WANTED)
    assert len(decoded) == 0


def test_null_without_branch_is_an_error():
    with pytest.raises(ValueError, match="no null branch"):
        encode_bodies((Field("a", "int"),), [pa.array([None], pa.int32())])
