"""Records that keep their own types, schemas looked up in tasks, and a stream that meets new ones."""

import json

import pyarrow as pa
import pytest
from builders import kafka, record
from pyspark.sql import functions as F

from vecsink.functions.avro import Field, record_fields
from vecsink.functions.avro_body import encode_bodies
from vecsink.functions.variant import ARROW, encode_objects
from vecsink.operators import envelope
from vecsink.operators.objects import to_wire
from vecsink.operators.variant_decode import decode_variants
from vecsink.plans.object_plan import plan_objects
from vecsink.plans.options import SinkOptions
from vecsink.plans.variant_plan import plan_variant_objects
from vecsink.sources import collection, schema_lookup
from vecsink.sources.kafka import stream_kafka_files
from vecsink.streaming.runner import run_native_stream

KINDS = {"int": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "bytes": pa.binary()}


def framed(schema_id, fields, *values):
    columns = [pa.array([v], KINDS[f.avro]) for f, v in zip(fields, values, strict=True)]
    return b"\x00" + schema_id.to_bytes(4, "big") + encode_bodies(tuple(fields), columns)[0].as_py()


def decoded(spark, schemas, rows, as_objects=False):
    parsed = envelope.parse_envelope(kafka(spark, [record(value, i) for i, value in enumerate(rows)]))
    frame = decode_variants(parsed, schema_lookup.SchemaTexts(schemas), as_objects)
    shown = frame.select("offset", "reject_reason", F.to_json("record").alias("j"), F.schema_of_variant("record").alias("kind"))
    return [(r["reject_reason"], r["j"] and json.loads(r["j"]), r["kind"]) for r in shown.orderBy("offset").collect()]


def test_all_types_and_nulls(spark):
    fields = [Field(n, a, 0) for n, a in (("z", "int"), ("long", "long"), ("f", "float"), ("d", "double"), ("b", "boolean"), ("s", "string"), ("raw", "bytes"))]
    full = framed(1, fields, -7, 2**63 - 1, 0.5, 1e300, True, "é" * 100, b"ab")
    found = decoded(spark, {1: fields}, [full, framed(1, fields, *[None] * 7)])
    assert found[0][:2] == (None, {"z": -7, "long": 2**63 - 1, "f": 0.5, "d": 1e300, "b": True, "s": "é" * 100, "raw": "YWI="})
    assert found[0][2] == "OBJECT<b: BOOLEAN, d: DOUBLE, f: FLOAT, long: BIGINT, raw: BINARY, s: STRING, z: BIGINT>"
    assert found[1][1] == dict.fromkeys(["z", "long", "f", "d", "b", "s", "raw"])


def test_types_stay_those_of_each_record(spark):
    schemas = {1: [Field("a", "long"), Field("a__as_b", "string")], 2: [Field("a", "double")], 3: [Field("a", "string")], 4: []}
    rows = [framed(1, schemas[1], 2**53 + 1, "x"), framed(2, schemas[2], 2.0), framed(3, schemas[3], "2"), b"\x00\x00\x00\x00\x04", framed(1, schemas[1], -1, "")]
    found = decoded(spark, schemas, rows)
    assert [f[1] for f in found] == [{"a": 2**53 + 1, "a__as_b": "x"}, {"a": 2.0}, {"a": "2"}, {}, {"a": -1, "a__as_b": ""}]
    assert [f[2] for f in found[:3]] == ["OBJECT<a: BIGINT, a__as_b: STRING>", "OBJECT<a: DOUBLE>", "OBJECT<a: STRING>"]


def test_rejects_have_their_reasons(spark):
    schemas = {1: [Field("n", "long"), Field("s", "string")], 2: None, 3: [Field("f", "float")], 5: [Field("_kafka_key", "string")]}
    good = framed(1, schemas[1], 5, "x")
    rows = [good, good[:-1], b"\x00\x00\x00\x00\x02abc", b"\x00\x00\x00\x00\x09abc", None, b"", framed(3, schemas[3], 1.5), framed(5, schemas[5], "k")]
    reasons = [None, "bad_payload", "unsupported_schema", "unknown_schema", "null_value", "short_value"]
    assert [f[0] for f in decoded(spark, schemas, rows)] == [*reasons, None, None]
    assert [f[0] for f in decoded(spark, schemas, rows, as_objects=True)] == [*reasons, "unsupported_schema", "unsupported_schema"]
    assert decoded(spark, schemas, []) == []


def test_text_that_is_not_utf8(spark):
    fields = [Field("s", "string")]
    raw = b"\x00\x00\x00\x00\x01" + encode_bodies((Field("s", "bytes"),), [pa.array([b"a\xffb"], pa.binary())])[0].as_py()
    assert decoded(spark, {1: fields}, [raw, framed(1, fields, "fine")])[0][1] == {"s": "a\ufffdb"}


@pytest.mark.parametrize("count", [0, 1, 255, 256, 400])
def test_many_fields(count):
    pyspark_variant = pytest.importorskip("pyspark.sql.types").VariantVal
    names = [f"field_{i}" for i in range(count)]
    made = encode_objects({n: ("long", pa.array([i, i + 2**40])) for i, n in enumerate(names)}, 2)
    assert made.type == ARROW
    for row, add in ((made[0], 0), (made[1], 2**40)):
        value = pyspark_variant(row["value"].as_py(), row["metadata"].as_py()).toPython()
        assert value == {n: i + add for i, n in enumerate(names)}


def test_objects_equal_those_of_the_column_form(spark):
    fields = {1: (Field("n", "long", 0), Field("s", "string", 0), Field("d", "double", 1)), 2: (Field("n", "long"), Field("i", "int", 0), Field("b", "boolean", 0))}
    rows = [framed(1, fields[1], 5, "x", 0.1), framed(1, fields[1], None, None, None), framed(2, fields[2], 7, None, None), framed(1, fields[1], None, "y", 1e20),
            framed(2, fields[2], 8, 3, True), b"\x00bad"]
    frame = kafka(spark, [record(v, i, key=None if i == 1 else b"k") for i, v in enumerate(rows)])
    for options in ({}, {"id": "n"}, {"id": "_kafka_offset"}):
        parsed = SinkOptions.parse({"className": "C", **options})
        variant = plan_variant_objects(frame, schema_lookup.SchemaTexts(fields), parsed)
        columns = plan_objects(frame, fields, parsed)

        def shown(sent):
            return {r["offset"]: (r["class"], r["id"], r["vector"], json.loads(r["properties"])) for r in sent.collect()}

        mine, other = shown(variant.objects()), shown(to_wire(columns.objects()))
        if options == {"id": "n"}:  # there the id is no property
            mine = {k: (*v[:3], {n: x for n, x in v[3].items() if n != "n"}) for k, v in mine.items()}
        if options == {"id": "_kafka_offset"}:
            mine = {k: (*v[:3], {n: x for n, x in v[3].items() if n != "_kafka_offset"}) for k, v in mine.items()}
        assert mine == other
        assert sorted((r["offset"], r["reject_reason"]) for r in variant.rejects().collect()) == sorted((r["offset"], r["reject_reason"]) for r in columns.rejects().collect())
    with pytest.raises(ValueError, match="no vector"):
        plan_variant_objects(frame, schema_lookup.SchemaTexts(fields), SinkOptions.parse({"className": "C", "vector": "v"}))


def text(*fields):
    return json.dumps({"type": "record", "name": "r", "fields": [{"name": n, "type": a} for n, a in fields]})


def landed(spark, rows, folder):
    schema_lookup.land_schemas(spark.createDataFrame(rows, "schema_id int, schema_json string"), folder)


def test_look_up(spark, tmp_path):
    folder = f"file://{tmp_path}/reg"
    landed(spark, [(1, text(("n", "long"))), (1, text(("n", "long"))), (-5, "syntax = proto3"), (None, "x")], folder)
    source = schema_lookup.SchemaFolder(folder)
    assert source.fields(1) == record_fields(text(("n", "long"))) and source.fields(-5) is None
    with pytest.raises(KeyError):
        source.fields(2)
    landed(spark, [(2, text(("s", "string")))], folder)
    assert source.fields(2)[0].name == "s" and source.fields(1)[0].name == "n"
    with pytest.raises(Exception, match="two different schemas"):
        landed(spark, [(3, text(("a", "long"))), (3, text(("b", "long")))], folder)
    (tmp_path / "7.json").write_text(json.dumps({"schema": text(("j", "int"))}))
    assert schema_lookup.SchemaFolder(f"file:{tmp_path}").fields(7)[0].name == "j"
    with pytest.raises(ValueError, match="no file system"):
        schema_lookup.SchemaFolder(str(tmp_path)).fields(7)


def test_where_a_registry_is_looked_up(spark, tmp_path):
    landed(spark, [(1, text(("n", "long")))], f"{tmp_path}/reg")
    assert schema_lookup.lookup_folder(spark, f"{tmp_path}/reg", f"{tmp_path}/spare") == f"file://{tmp_path}/reg"
    assert schema_lookup.lookup_folder(spark, f"{tmp_path}/answers/*.json", "x") == f"file://{tmp_path}/answers"
    spark.createDataFrame([(4, text(("q", "long")))], "schema_id int, schema_json string").write.parquet(f"{tmp_path}/plain")
    spare = schema_lookup.lookup_folder(spark, f"{tmp_path}/plain", f"{tmp_path}/spare")
    assert spare == f"file://{tmp_path}/spare" and schema_lookup.SchemaFolder(spare).fields(4)[0].name == "q"


def test_a_running_native_stream_meets_a_new_schema(spark, tmp_path):
    """No restart, and nothing of the registry is read on the driver."""
    one, two = (("n", "long"),), (("n", "double"), ("more", "string"))
    landed(spark, [(1, text(*one))], f"{tmp_path}/reg")

    def land(schema_id, fields, values, start):
        made = [record(framed(schema_id, [Field(n, a) for n, a in fields], *v), start + i) for i, v in enumerate(values)]
        kafka(spark, made).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    land(1, one, [(2**53 + 1,)], 0)
    options = {"className": "C", "path": f"{tmp_path}/out", "run": "n", "registry": f"{tmp_path}/reg"}
    query = run_native_stream(stream_kafka_files(spark, f"{tmp_path}/in"), options, f"{tmp_path}/cp", trigger_seconds=0.3)
    query.processAllAvailable()
    landed(spark, [(2, text(*two))], f"{tmp_path}/reg")
    land(2, two, [(2.5, "x"), (3.0, "y")], 1)
    query.processAllAvailable()
    started = query.id
    # An id that nobody has registered stops the strict stream; it is found once it is there.
    land(3, two, [(9.0, "z")], 3)
    with pytest.raises(Exception, match="unknown_schema"):
        query.processAllAvailable()
    landed(spark, [(3, text(*two))], f"{tmp_path}/reg")
    query = run_native_stream(stream_kafka_files(spark, f"{tmp_path}/in"), options, f"{tmp_path}/cp")
    query.awaitTermination()
    assert query.id == started
    stored = collection.read_collection(spark, f"{tmp_path}/out", "C").collect()
    assert sorted((r["offset"], json.loads(r["properties"])["n"]) for r in stored) == [(0, 2**53 + 1), (1, 2.5), (2, 3.0), (3, 9.0)]
