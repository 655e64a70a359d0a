import json
import sys
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from builders import SCHEMAS, framed, kafka, record
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vecsink.operators import checks
from vecsink.operators.delivery import accept_all
from vecsink.plans.object_plan import plan_objects
from vecsink.plans.options import SinkOptions
from vecsink.sinks.datasource import FORMAT, register_sink
from vecsink.sinks.writers import send_objects, write_kafka
from vecsink.sources import collection, target_class
from vecsink.sources.kafka import read_kafka_files, stream_kafka_files
from vecsink.sources.scratch import CHECKPOINT_DIR, scratch_folder
from vecsink.streaming.runner import run_native_stream, run_stream

# The transports below travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows(count, start=0, partition=0):
    return [record(framed(1 + i % 2, i, f"s{i}", *([True] if i % 2 else [])), i, partition) for i in range(start, start + count)]


def refuse_odd(batch, attempt):
    numbers = [json.loads(p)["n"] for p in batch.column("properties").to_pylist()]
    return pa.array([("odd" if n % 2 else None) for n in numbers], pa.string())


def stored_numbers(spark, path):
    return sorted(r["n"] for r in collection.read_collection(spark, str(path), "C").select("properties.n").collect())


def sent_numbers(spark, path):
    stored = collection.read_collection(spark, str(path), "C")
    return sorted(json.loads(r["properties"])["n"] for r in stored.collect())


def built(spark, count=25):
    return plan_objects(kafka(spark, rows(count)), SCHEMAS, SinkOptions.parse({"className": "C"})).objects()


def test_batch_write_stores_every_object(spark, tmp_path):
    frame = kafka(spark, rows(25)).repartition(3)
    write_kafka(frame, {"className": "C", "path": str(tmp_path)}, SCHEMAS)
    assert stored_numbers(spark, tmp_path) == list(range(25))


def test_batch_sink_stores_what_was_sent(spark, tmp_path):
    frame = kafka(spark, rows(25)).repartition(3)
    write_kafka(frame, {"CLASSNAME": "C", "path": str(tmp_path), "batchsize": 4}, SCHEMAS, transport=accept_all)
    assert sent_numbers(spark, tmp_path) == list(range(25))
    assert all(r["vector"] is None for r in collection.read_collection(spark, str(tmp_path)).collect())


def test_stored_files_do_not_have_a_row_group_per_batch(spark, tmp_path):
    frame = kafka(spark, rows(50)).coalesce(1)
    write_kafka(frame, {"className": "C", "path": str(tmp_path), "batchSize": 4}, SCHEMAS, transport=accept_all)
    (file,) = tmp_path.rglob("part-*")
    assert pq.ParquetFile(file).metadata.num_row_groups == 1 and pq.ParquetFile(file).metadata.num_rows == 50


def test_nothing_is_sent_for_nothing(spark, tmp_path):
    def never(batch, attempt):
        raise AssertionError("called")

    options = {"className": "C", "path": str(tmp_path), "retries": 0}
    write_kafka(kafka(spark, []), options, SCHEMAS, transport=never)
    send_objects(built(spark, 3).where("id = 'none'").repartition(4), options, never)
    assert not list(tmp_path.rglob("outcome=*"))


def test_append_only(spark, tmp_path):
    with pytest.raises(ValueError, match="append"):
        write_kafka(kafka(spark, []), {"className": "C", "path": str(tmp_path)}, SCHEMAS, mode="overwrite")
    register_sink(spark, accept_all)
    wired = built(spark).withColumn("properties", F.to_json("properties"))
    with pytest.raises(Exception, match="only appends"):
        wired.write.format(FORMAT).option("className", "C").mode("overwrite").save()


def test_sink_needs_objects_and_somewhere_to_send(spark, tmp_path):
    register_sink(spark, accept_all)
    with pytest.raises(Exception, match="takes object frames"):
        kafka(spark, rows(1)).write.format(FORMAT).option("className", "C").mode("append").save()
    wired = built(spark).withColumn("properties", F.to_json("properties"))
    with pytest.raises(Exception, match="only sends"):
        wired.write.format(FORMAT).option("className", "C").option("path", str(tmp_path)).mode("append").save()
    wired.write.format(FORMAT).option("className", "C").mode("append").save()
    register_sink(spark, refuse_odd)
    with pytest.raises(Exception, match="could not be sent"):
        wired.write.format(FORMAT).options(className="C", retries="0").mode("append").save()
    with pytest.raises(ValueError, match="a transport or"):
        write_kafka(kafka(spark, []), {"className": "C"}, SCHEMAS)


def test_exhausted_retries_fail_the_job_and_leave_nothing_stored(spark, tmp_path):
    options = {"className": "C", "path": str(tmp_path), "retries": 1, "retriesBackoff": 0}
    with pytest.raises(Exception, match="could not be sent"):
        send_objects(built(spark), options, refuse_odd)
    assert not list(tmp_path.rglob("part-*"))


def test_collected_failures_are_kept_with_their_error(spark, tmp_path):
    options = {"className": "C", "path": str(tmp_path), "onError": "collect", "retries": 0, "batchSize": 4}
    send_objects(built(spark), options, refuse_odd)
    assert sent_numbers(spark, tmp_path) == list(range(0, 25, 2))
    failed = collection.read_failures(spark, str(tmp_path), "C").collect()
    assert sorted(json.loads(r["properties"])["n"] for r in failed) == list(range(1, 25, 2))
    assert {(r["error"], r["attempt"]) for r in failed} == {("odd", 1)}


def test_every_outcome_of_a_batch_comes_from_one_pass_and_is_replaced_as_a_whole(spark, tmp_path):
    """Bodies are sent once; a batch that is written again replaces all that an earlier run has set aside."""
    calls = spark.sparkContext.accumulator(0)

    def counting(batch, attempt):
        calls.add(batch.num_rows)
        return refuse_odd(batch, attempt)

    mixed = kafka(spark, rows(25) + [record(None, 99), record(b"\x00\x00\x00\x00\x09body", 100)]).repartition(3)
    options = {"className": "C", "path": str(tmp_path), "run": "r", "onError": "collect", "keepRejects": True, "retries": 0, "batchSize": 4}
    write_kafka(mixed, options, SCHEMAS, transport=counting, batch_id=1)
    assert calls.value == 25
    assert sent_numbers(spark, tmp_path) == list(range(0, 25, 2))
    assert collection.read_failures(spark, str(tmp_path), "C").count() == 12
    aside = collection.read_rejects(spark, str(tmp_path), "C").collect()
    assert sorted((r["offset"], r["reject_reason"], r["run"], r["batch_id"]) for r in aside) == [(99, "null_value", "r", 1), (100, "unknown_schema", "r", 1)]
    assert next(r["value"] for r in aside if r["offset"] == 100) == b"\x00\x00\x00\x00\x09body"
    write_kafka(kafka(spark, rows(4)), options, SCHEMAS, transport=accept_all, batch_id=1)
    assert sent_numbers(spark, tmp_path) == [0, 1, 2, 3]
    assert collection.read_failures(spark, str(tmp_path), "C").count() == 0
    assert collection.read_rejects(spark, str(tmp_path), "C").count() == 0
    assert collection.object_counts(spark, str(tmp_path)).collect()[0]["objects"] == 4


def test_options_that_moved(spark, tmp_path):
    for old in ("rejectsPath", "failuresPath"):
        with pytest.raises(ValueError, match="no option"):
            write_kafka(kafka(spark, []), {"className": "C", "path": str(tmp_path), old: "x"}, SCHEMAS)
    with pytest.raises(ValueError, match="need path"):
        write_kafka(kafka(spark, []), {"className": "C", "keepRejects": True}, SCHEMAS, transport=accept_all)


def test_same_batch_again_replaces_itself(spark, tmp_path):
    options = {"className": "C", "path": str(tmp_path), "run": "r"}
    for count in (25, 10):
        write_kafka(kafka(spark, rows(count)).repartition(2), options, SCHEMAS, batch_id=3)
        assert collection.scan_collection(spark, str(tmp_path), "C").count() == count
    for parts in (4, 1):
        frame = kafka(spark, rows(25)).repartition(parts)
        write_kafka(frame, {**options, "path": str(tmp_path / "x")}, SCHEMAS, transport=accept_all, batch_id=3)
        assert collection.scan_collection(spark, str(tmp_path / "x"), "C").count() == 25


def test_rejects_need_a_place_or_fail_the_job(spark, tmp_path):
    mixed = kafka(spark, rows(5) + [record(None, 99)])
    with pytest.raises(Exception, match="null_value"):
        write_kafka(mixed, {"className": "C", "path": str(tmp_path / "a")}, SCHEMAS)
    write_kafka(mixed, {"className": "C", "path": str(tmp_path / "b"), "keepRejects": True}, SCHEMAS)
    assert stored_numbers(spark, tmp_path / "b") == list(range(5))
    assert [(r["offset"], r["reject_reason"]) for r in collection.read_rejects(spark, str(tmp_path / "b"), "C").collect()] == [(99, "null_value")]


def test_later_write_wins_per_id(spark, tmp_path):
    options = {"className": "C", "path": str(tmp_path), "id": "s"}
    first = [record(framed(1, n, s), n) for n, s in [(1, "a"), (2, "b"), (3, "a")]]
    write_kafka(kafka(spark, first), options, SCHEMAS)
    found = {r["id"]: r["properties"]["n"] for r in collection.read_collection(spark, str(tmp_path), "C").collect()}
    assert found == {"a": 3, "b": 2}
    write_kafka(kafka(spark, [record(framed(1, 9, "b"), 0)]), options, SCHEMAS)
    found = {r["id"]: r["properties"]["n"] for r in collection.read_collection(spark, str(tmp_path), "C").collect()}
    assert found == {"a": 3, "b": 9}
    counts = collection.object_counts(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in counts] == [("C", 2)]


def test_later_batches_may_have_more_properties(spark, tmp_path):
    options = {"className": "C", "path": str(tmp_path)}
    write_kafka(kafka(spark, [record(framed(1, 1, "a"), 0)]), options, {1: SCHEMAS[1]})
    write_kafka(kafka(spark, [record(framed(2, 2, "b", True), 1)]), options, SCHEMAS)
    merged = collection.read_collection(spark, str(tmp_path), "C")
    assert {(r["n"], r["flag"]) for r in merged.select("properties.n", "properties.flag").collect()} == {(1, None), (2, True)}
    again = collection.read_collection(spark, str(tmp_path), "C", schema=collection.scan_collection(spark, str(tmp_path)).schema)
    assert again.count() == 2


def test_class_filter_prunes_folders(spark, tmp_path):
    for name in ("C", "D"):
        write_kafka(kafka(spark, rows(2)), {"className": name, "path": str(tmp_path)}, SCHEMAS)
    scan = collection.scan_collection(spark, str(tmp_path), "D")
    assert scan.count() == 2
    assert all("/class=D/" in name for name in scan.inputFiles())
    with pytest.raises(ValueError, match="cannot name a folder"):
        write_kafka(kafka(spark, rows(2)), {"className": "../x", "path": str(tmp_path)}, SCHEMAS)


def land(spark, folder, parts):
    """One file per part, in order."""
    for part in parts:
        kafka(spark, part).coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_equals_batch_and_counts_each_batch(spark, tmp_path):
    parts = [rows(5), rows(5, 5) + [record(None, 100)], rows(5, 10)]
    land(spark, tmp_path / "in", parts)
    stream = stream_kafka_files(spark, str(tmp_path / "in"), max_files=1)
    options = {"className": "C", "path": str(tmp_path / "out"), "run": "s", "keepRejects": True}
    run = run_stream(stream, options, str(tmp_path / "cp"), SCHEMAS)
    totals = run.finish()
    assert (totals.rows, totals.rejected, totals.last[0]) == (16, 1, 2)
    assert run.query.name == "s" and run.query.exception() is None
    batch = kafka(spark, [])
    for part in parts:
        batch = batch.union(kafka(spark, part))
    columns = ["class", "id", "vector", "properties", "topic", "partition", "offset"]
    expected = plan_objects(batch, SCHEMAS, SinkOptions.parse({"className": "C"})).objects().select(*columns)
    streamed = collection.read_collection(spark, str(tmp_path / "out"), "C").select(*columns)
    key = lambda r: r["id"]
    assert sorted(streamed.collect(), key=key) == sorted(expected.collect(), key=key)
    per_batch = collection.batch_totals(spark, str(tmp_path / "out"), "C", "s")
    assert sorted(tuple(r) for r in per_batch.collect()) == [(0, 5), (1, 5), (2, 5)]
    assert collection.read_rejects(spark, str(tmp_path / "out"), "C").count() == 1


def test_restart_continues_and_replay_replaces(spark, tmp_path):
    land(spark, tmp_path / "in", [rows(5), rows(5, 5)])
    options = {"className": "C", "path": str(tmp_path / "out"), "run": "s"}

    def go():
        stream = stream_kafka_files(spark, str(tmp_path / "in"), max_files=1)
        return run_stream(stream, options, str(tmp_path / "cp"), SCHEMAS).finish()

    assert go().rows == 10
    assert go().rows == 10
    # Lose the commit of the last micro-batch, as a crash after its write would.
    for name in ("1", ".1.crc"):
        (tmp_path / "cp" / "commits" / name).unlink()
    land(spark, tmp_path / "in", [rows(5, 10)])
    totals = go()
    assert (totals.rows, totals.last) == (15, (2, 5, 0))
    assert stored_numbers(spark, tmp_path / "out") == list(range(15))
    assert collection.scan_collection(spark, str(tmp_path / "out"), "C").count() == 15


def test_native_stream_sink_and_its_replay(spark, tmp_path):
    land(spark, tmp_path / "in", [rows(5), rows(7, 5)])
    options = {"className": "C", "path": str(tmp_path / "out"), "run": "n", "batchSize": 3}

    def go():
        stream = stream_kafka_files(spark, str(tmp_path / "in"), max_files=1)
        query = run_native_stream(stream, options, str(tmp_path / "cp"), SCHEMAS)
        query.awaitTermination()
        return query

    assert go().exception() is None
    assert sent_numbers(spark, tmp_path / "out") == list(range(12))
    for name in ("1", ".1.crc"):
        (tmp_path / "cp" / "commits" / name).unlink()
    go()
    assert collection.scan_collection(spark, str(tmp_path / "out"), "C").count() == 12
    assert {Path(p).parent.parent.name for p in map(str, (tmp_path / "out").rglob("part-*"))} == {"batch_id=0", "batch_id=1"}


def test_stream_through_a_transport_keeps_the_same_folders(spark, tmp_path):
    land(spark, tmp_path / "in", [rows(5), rows(5, 5)])
    stream = stream_kafka_files(spark, str(tmp_path / "in"), max_files=1)
    options = {"className": "C", "path": str(tmp_path / "out"), "run": "s", "retries": 0, "onError": "collect"}
    totals = run_stream(stream, options, str(tmp_path / "cp"), SCHEMAS, transport=refuse_odd).finish()
    assert totals.rows == 10
    per_batch = collection.batch_totals(spark, str(tmp_path / "out"), "C", "s")
    assert sorted(tuple(r) for r in per_batch.collect()) == [(0, 3), (1, 2)]
    assert collection.read_failures(spark, str(tmp_path / "out"), "C").count() == 5


def test_stream_faults(spark, tmp_path):
    land(spark, tmp_path / "in", [rows(2)])
    stream = stream_kafka_files(spark, str(tmp_path / "in"))
    with pytest.raises(ValueError, match="run"):
        run_stream(stream, {"className": "C", "path": "x"}, str(tmp_path / "cp"), SCHEMAS)
    with pytest.raises(ValueError, match="strict"):
        run_native_stream(
            stream, {"className": "C", "path": "x", "run": "n", "keepRejects": True}, str(tmp_path / "cp"), SCHEMAS
        )
    land(spark, tmp_path / "bad", [[record(None, 5)]])
    bad = stream_kafka_files(spark, str(tmp_path / "bad"))
    with pytest.raises(Exception, match="null_value"):
        run_stream(bad, {"className": "C", "path": str(tmp_path / "o"), "run": "b"}, str(tmp_path / "cp2"), SCHEMAS).finish()


def test_bounded_run_and_new_schemas_without_restart(spark, tmp_path):
    def text(schema_id):
        fields = [{"name": f.name, "type": f.avro if f.null_branch is None else ["null", f.avro]} for f in SCHEMAS[schema_id]]
        return json.dumps({"type": "record", "name": "r", "fields": fields})

    def add(schema_id):
        row = [(schema_id, text(schema_id))]
        spark.createDataFrame(row, "schema_id int, schema_json string").write.mode("append").parquet(str(tmp_path / "reg"))

    add(1)
    land(spark, tmp_path / "in", [[record(framed(1, 1, "a"), 0)]])
    options = {"className": "C", "path": str(tmp_path / "out"), "run": "s", "registry": str(tmp_path / "reg")}
    stream = stream_kafka_files(spark, str(tmp_path / "in"))
    run = run_stream(stream, options, str(tmp_path / "cp"), trigger_seconds=0.5)
    run.query.processAllAvailable()
    add(2)
    land(spark, tmp_path / "in", [[record(framed(2, 2, "b", True), 1)]])
    run.query.processAllAvailable()
    assert run.finish(seconds=0.1).rows == 2 and not run.query.isActive
    assert stored_numbers(spark, tmp_path / "out") == [1, 2]


def test_landed_records_as_a_table(spark, tmp_path):
    land(spark, tmp_path / "in", [rows(3), rows(2, 3)])
    assert read_kafka_files(spark, str(tmp_path / "in")).count() == 5


def test_reconcile_and_sample(spark):
    source = spark.range(5)
    assert tuple(checks.reconcile(source, source).first()) == (5, 5, True)
    assert tuple(checks.reconcile(source, source.limit(3)).first()) == (5, 3, False)
    assert tuple(checks.reconcile(source.limit(0), source.limit(0)).first()) == (0, 0, True)
    assert [r["n"] for r in checks.sample_objects(built(spark)).select("properties.n").collect()] != []


def test_declared_class(spark, tmp_path):
    declared = {
        "class": "Clickstream",
        "properties": [
            {"name": n, "dataType": [t]}
            for n, t in [("_kafka_key", "string"), ("_kafka_topic", "string"), ("_kafka_partition", "int"),
                         ("_kafka_offset", "int"), ("_kafka_timestamp", "date"), ("_kafka_timestampType", "int"),
                         ("_kafka_schema_id", "string"), ("n", "int"), ("s", "string"), ("flag", "int")]
        ],
    }
    file = tmp_path / "class.json"
    file.write_text(json.dumps(declared, indent=2))
    loaded = target_class.load_class(spark, str(file))
    assert loaded.count() == 10 and {r["class"] for r in loaded.collect()} == {"Clickstream"}
    made = plan_objects(kafka(spark, rows(4)), SCHEMAS, SinkOptions.parse({"className": "C"})).rows()
    report = {r["property"]: (r["status"], r["produced_values"]) for r in checks.class_conformance(made, loaded).collect()}
    assert report["_kafka_schema_id"] == ("not_produced", 0) and report["_kafka_schemaId"] == ("undeclared", 4)
    assert report["flag"] == ("type_mismatch", 2) and report["n"] == ("ok", 4)


def test_scratch_folder_follows_the_session(spark, monkeypatch):
    assert scratch_folder(spark, "a") != scratch_folder(spark, "a")
    # The setting is fixed when a session starts, so it is put in place of the real one here.
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: {CHECKPOINT_DIR: "hdfs://shared/tmp"}[key])
    assert scratch_folder(spark, "a").startswith("hdfs://shared/tmp/a-")


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        scratch_folder(spark, "a")
