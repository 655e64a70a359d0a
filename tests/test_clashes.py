"""Fields of one name with several types, in the column form."""

import json

import pyarrow as pa
from builders import kafka, record

from vecsink.functions.avro import Field, settle_conflicts, written_names
from vecsink.functions.avro_body import encode_bodies
from vecsink.operators.objects import to_wire
from vecsink.plans.object_plan import plan_objects
from vecsink.plans.options import SinkOptions

KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string()}


def framed(schema_id, fields, *values):
    columns = [pa.array([v], KINDS[f.avro]) for f, v in zip(fields, values, strict=True)]
    return b"\x00" + schema_id.to_bytes(4, "big") + encode_bodies(tuple(fields), columns)[0].as_py()


def test_values_and_names_stay(spark):
    schemas = {
        1: (Field("a", "long"), Field("sold__as_is", "string"), Field("sold", "long")),
        2: (Field("a", "double"), Field("a__as_double", "string")),
        3: (Field("a", "int"),),
        4: (Field("a", "string"),),
    }
    rows = [framed(1, schemas[1], 2**53 + 1, "x", 3), framed(2, schemas[2], 1.5, "named"), framed(3, schemas[3], 4), framed(4, schemas[4], "four")]
    plan = plan_objects(kafka(spark, [record(v, i) for i, v in enumerate(rows)]), schemas, SinkOptions.parse({"className": "C"}))
    sent = {r["offset"]: r["properties"] for r in to_wire(plan.objects()).collect()}
    own = {k: {n: x for n, x in json.loads(v).items() if not n.startswith("_kafka")} for k, v in sent.items()}
    assert own == {0: {"a": 2**53 + 1, "sold__as_is": "x", "sold": 3}, 1: {"a": 1.5, "a__as_double": "named"}, 2: {"a": 4}, 3: {"a": "four"}}
    assert '"a":9007199254740993' in sent[0] and sent[0].count('"sold"') == 1


def test_names_of_columns_are_free():
    settled = settle_conflicts({1: (Field("a", "long"), Field("a__as_string", "long")), 2: (Field("a", "string"),), 3: (Field("a", "string"),), 4: None})
    assert settled[2] == settled[3] == (Field("a__as_string_", "string", None, "a"),)
    assert written_names(settled) == {"a__as_string_": "a"} and settled[4] is None
