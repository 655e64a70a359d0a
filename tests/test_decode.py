import json

import pytest
from builders import SCHEMAS, framed, kafka, record

from vecsink import fixtures
from vecsink.functions.avro import Field, SchemaConflictError, UnsupportedTypeError
from vecsink.operators import decode, enrich, envelope
from vecsink.operators.objects import to_wire
from vecsink.plans.object_plan import plan_objects
from vecsink.plans.options import SinkOptions
from vecsink.sources import registry


def plan(frame, schemas=SCHEMAS, **options):
    return plan_objects(frame, schemas, SinkOptions.parse({"className": "C", **options}))


def test_damaged_bodies_are_rejects_and_the_rest_is_whole(spark):
    good = framed(1, 5, "hello")
    rows = [
        record(good, 0),
        record(good[:-2], 1),
        record(framed(2, 6, None, None), 2),
        record(b"\x00\x00\x00\x00\x09body", 3),
        record(None, 4),
        record(good + b"tail", 5),
    ]
    made = plan(kafka(spark, rows))
    assert {r["offset"]: r["reject_reason"] for r in made.rejects().collect()} == {
        1: "bad_payload", 3: "unknown_schema", 4: "null_value"}
    kept = {r["_kafka_offset"]: (r["n"], r["s"], r["flag"]) for r in made.rows().collect()}
    assert kept == {0: (5, "hello", None), 2: (6, None, None), 5: (5, "hello", None)}
    assert made.rejects().count() + made.rows().count() == len(rows)


def test_absent_field_stays_absent_and_present_null_gets_its_default(spark):
    rows = [record(framed(1, 5, "x"), 0), record(framed(2, 6, None, None), 1)]
    built = {r["properties"]["n"]: r for r in plan(kafka(spark, rows)).objects().collect()}
    assert built[5]["properties"]["flag"] is None
    assert built[6]["properties"]["flag"] is False and built[6]["properties"]["s"] == ""
    texts = [json.loads(r["properties"]) for r in to_wire(plan(kafka(spark, rows)).objects()).collect()]
    assert sorted("flag" in t for t in texts) == [False, True]


def test_metadata_order_and_values(spark):
    row = plan(kafka(spark, [record(framed(1, 5, "x"), 9, 3, key=None)])).rows()
    assert row.columns[-7:] == list(enrich.METADATA)
    first = row.first()
    assert (first["_kafka_key"], first["_kafka_offset"], first["_kafka_timestamp"].microsecond) == (None, 9, 123000)
    assert plan(kafka(spark, [record(framed(1, 5, "x"), key=None)])).objects().first()["properties"]["_kafka_key"] == ""


def test_strict_fails_at_a_reject(spark):
    rows = [record(framed(1, 5, "x"), 0), record(b"\x00\x00\x00\x00\x09body", 7, 2)]
    with pytest.raises(Exception, match="rejected record t/2/7: unknown_schema"):
        plan(kafka(spark, rows)).rows(strict=True).collect()
    assert plan(kafka(spark, rows[:1])).rows(strict=True).count() == 1


def test_null_id_is_a_reject(spark):
    rows = [record(framed(2, 5, "x", None), 0), record(framed(2, 6, None, None), 1)]
    made = plan(kafka(spark, rows), id="s")
    assert [r["id"] for r in made.objects().collect()] == ["x"]
    assert [(r["offset"], r["reject_reason"]) for r in made.rejects().collect()] == [(1, "null_id")]
    keyed = plan(kafka(spark, [record(framed(1, 1, "a"), 0, key=None), record(framed(1, 1, "a"), 1)]), id="_kafka_key")
    assert [r["id"] for r in keyed.objects().collect()] == ["k"]


def test_record_without_a_position_has_no_id(spark):
    rows = [record(framed(1, 5, "x"), 0), record(framed(1, 6, "x"), None), record(framed(1, 7, "x"), 2, topic=None)]
    made = plan(kafka(spark, rows))
    assert made.objects().count() == 1
    assert {r["reject_reason"] for r in made.rejects().collect()} == {"null_id"} and made.rejects().count() == 2
    assert plan(kafka(spark, rows), idMode="random").objects().select("id").distinct().count() == 3


def test_unsupported_schema_concerns_only_its_own_records(spark):
    schemas = {**SCHEMAS, 3: None}
    rows = [record(framed(1, 5, "x"), 0), record(b"\x00\x00\x00\x00\x03body", 1)]
    made = plan(kafka(spark, rows), schemas)
    assert [r["reject_reason"] for r in made.rejects().collect()] == ["unsupported_schema"]
    assert made.rows().count() == 1 and "flag" in made.rows().columns


def test_field_names_like_record_columns_do_not_collide(spark):
    schemas = {1: (Field("offset", "string"), Field("topic", "long"), Field("value", "string"))}
    rows = [record(framed(1, "o", 4, "v", schemas=schemas), 12)]
    row = plan(kafka(spark, rows), schemas).rows().first()
    assert (row["offset"], row["topic"], row["value"], row["_kafka_offset"], row["_kafka_topic"]) == ("o", 4, "v", 12, "t")


def test_metadata_names_are_reserved(spark):
    schemas = {1: (Field("_kafka_offset", "long"),)}
    with pytest.raises(SchemaConflictError):
        plan(kafka(spark, []), schemas).rows()


def test_float_field_decodes_but_is_no_property(spark):
    schemas = {1: (Field("f", "float"), Field("s", "string"))}
    frame = kafka(spark, [record(framed(1, 0.5, "x", schemas=schemas))])
    assert plan(frame, schemas).rows().first()["f"] == 0.5
    with pytest.raises(UnsupportedTypeError):
        plan(frame, schemas).objects()


def test_malformed_text_is_replaced(spark):
    value = framed(1, 5, "ab").replace(b"ab", b"a\xff")
    assert plan(kafka(spark, [record(value)])).rows().first()["s"] == "a�"


def test_bodies_are_decoded_once_and_only_the_body_travels(spark):
    made = plan(kafka(spark, [record(framed(1, 5, "x"))]))
    text = made.objects()._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1 and "Exchange" not in text
    assert "decode(schema_id" in text


def test_wanted_fields(spark):
    frame = kafka(spark, [record(framed(2, 6, "y", True))])
    decoded = decode.decode_values(envelope.parse_envelope(frame), SCHEMAS, fields=["flag"])
    assert decoded.select("record.*").columns == ["flag"] and decoded.first()["record"]["flag"] is True
    with pytest.raises(ValueError, match="no schema has"):
        decode.decode_values(envelope.parse_envelope(frame), SCHEMAS, fields=["nope"])


def test_no_schemas_at_all(spark):
    made = plan_objects(kafka(spark, [record(framed(1, 5, "x"))]), {}, SinkOptions.parse({"className": "C"}))
    assert [r["reject_reason"] for r in made.rejects().collect()] == ["unknown_schema"]


def response(text):
    return json.dumps({"schema": text})


def test_registry_forms(spark, tmp_path):
    texts = fixtures.SCHEMA_TEXTS
    folder = tmp_path / "responses"
    folder.mkdir()
    for schema_id, text in texts.items():
        (folder / f"{schema_id}.json").write_text(response(text))
    spark.createDataFrame(list(texts.items()), "schema_id int, schema_json string").write.parquet(str(tmp_path / "table"))
    fixtures.registry(spark).write.parquet(str(tmp_path / "raw"))
    for place in (f"{folder}/*.json", str(tmp_path / "table"), str(tmp_path / "raw")):
        assert registry.registry_schemas(registry.load_registry(spark, place)) == fixtures.SCHEMAS
    with pytest.raises(ValueError, match="HTTP"):
        registry.load_registry(spark, "https://registry.example")


def test_registry_lookup_of_one_id(spark):
    known = registry.registry_from_responses(fixtures.registry(spark))
    text = registry.schema_by_id(known, fixtures.V2)
    assert text.startswith("{") and text.endswith("}")
    with pytest.raises(registry.UnknownSchemaError, match="999999"):
        registry.schema_by_id(known, 999999)


@pytest.mark.parametrize("bad", ['{"other": 1}', '{"schema": 5}', '{"schema": null}', "not json", '{"schema": {"a": 1}}'])
def test_response_without_schema_text_raises(spark, bad):
    frame = spark.createDataFrame([(1, bad)], "schema_id int, response string")
    with pytest.raises(Exception, match="no schema text"):
        registry.registry_from_responses(frame).collect()


def test_registry_conflicts_and_pruning(spark):
    texts = fixtures.SCHEMA_TEXTS
    rows = [(1, texts[fixtures.V1]), (1, texts[fixtures.V1]), (2, texts[fixtures.V2])]
    known = spark.createDataFrame(rows, "schema_id int, schema_json string")
    assert set(registry.registry_schemas(known)) == {1, 2}
    with pytest.raises(SchemaConflictError):
        registry.registry_schemas(known.union(spark.createDataFrame([(2, texts[fixtures.V1])], known.schema)))
    parsed = envelope.parse_envelope(kafka(spark, [record(framed(2, 6, "y", True))]))
    pruned = registry.prune_registry(known, parsed)
    assert set(registry.registry_schemas(pruned)) == {2}
    # A repeated entry does not repeat records.
    joined = registry.with_schema_text(parsed, known)
    assert [(r["schema_id"], r["schema_json"]) for r in joined.select("schema_id", "schema_json").collect()] == [
        (2, texts[fixtures.V2])]


def test_registry_with_schemas_of_other_topics(spark):
    other = json.dumps({"type": "record", "name": "o", "fields": [{"name": "m", "type": {"type": "map", "values": "int"}}]})
    rows = [(1, fixtures.SCHEMA_TEXTS[fixtures.V1]), (2, other)]
    known = spark.createDataFrame(rows, "schema_id int, schema_json string")
    with pytest.raises(UnsupportedTypeError):
        registry.registry_schemas(known)
    assert registry.registry_schemas(known, set_aside=True) == {1: fixtures.SCHEMAS[fixtures.V1], 2: None}


def test_statistics_and_one_schema(spark):
    rows = [record(framed(1, 5, "x"), 3), record(framed(1, 5, "x"), 8), record(framed(2, 6, "y", True), 4), record(None, 1)]
    parsed = envelope.parse_envelope(kafka(spark, rows))
    stats = {r["schema_id"]: tuple(r)[1:] for r in envelope.schema_statistics(parsed).collect()}
    assert stats == {1: (2, 3, 8), 2: (1, 4, 4)}
    assert {r[0] for r in envelope.distinct_schema_ids(parsed).collect()} == {1, 2}
    assert envelope.of_schema(parsed, 1).count() == 2
