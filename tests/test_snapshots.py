"""A compacted collection reads as the collection does."""

import random

import pytest
from builders import SCHEMAS, framed, kafka, record

from vecsink.sinks.writers import write_kafka
from vecsink.sources.collection import read_collection
from vecsink.sources.snapshots import compact, latest_version, read_compacted


def land(spark, path, batch, numbers, schemas=SCHEMAS, schema=1):
    rows = [record(framed(schema, n, f"{batch}-{i}", *([True] if schema == 2 else [])), i) for i, n in enumerate(numbers)]
    write_kafka(kafka(spark, rows), {"className": "C", "path": path, "id": "n"}, schemas, batch_id=batch)


def objects(frame):
    return {(r["id"], r["properties"]["s"]) for r in frame.collect()}


def same(spark, path):
    whole = objects(read_collection(spark, path, "C"))
    assert objects(read_compacted(spark, path, "C")) == whole
    return whole


def test_every_state_reads_as_the_collection(spark, tmp_path):
    path, rng = str(tmp_path), random.Random(4)
    for batch in range(4):
        land(spark, path, batch, [rng.randrange(60) for _ in range(30)])
        same(spark, path)
        if batch != 1:
            assert compact(spark, path, "C") == {0: 1, 2: 2, 3: 3}[batch]
            same(spark, path)
    assert compact(spark, path, "C") is None
    assert len(same(spark, path)) > 40


def test_a_batch_written_again_is_not_read_from_a_version(spark, tmp_path):
    path = str(tmp_path)
    land(spark, path, 1, [1, 2, 3])
    assert compact(spark, path, "C") == 1
    land(spark, path, 2, [2, 4])
    assert compact(spark, path, "C") == 2
    land(spark, path, 2, [4])
    assert latest_version(spark, path, "C") == 1
    assert same(spark, path) == {("1", "1-0"), ("2", "1-1"), ("3", "1-2"), ("4", "2-0")}
    land(spark, path, 1, [5])
    assert latest_version(spark, path, "C") is None
    assert same(spark, path) == {("4", "2-0"), ("5", "1-0")}
    assert compact(spark, path, "C") == 3
    same(spark, path)


def test_a_version_without_covers_does_not_count(spark, tmp_path):
    path = str(tmp_path)
    land(spark, path, 1, [1, 2])
    read_collection(spark, path, "C").limit(1).write.parquet(f"{path}/_snapshots/class=C/objects/version=1")
    assert len(same(spark, path)) == 2
    assert compact(spark, path, "C") == 1
    assert len(same(spark, path)) == 2


def test_later_batches_may_have_more_properties(spark, tmp_path):
    path = str(tmp_path)
    land(spark, path, 1, [1, 2], {1: SCHEMAS[1]})
    compact(spark, path, "C")
    land(spark, path, 2, [2, 3], schema=2)
    read = {r["id"]: r["properties"]["flag"] for r in read_compacted(spark, path, "C").collect()}
    assert read == {"1": None, "2": True, "3": True}
    compact(spark, path, "C")
    assert len(same(spark, path)) == 3


def test_objects_are_sorted_and_other_classes_stay_out(spark, tmp_path):
    path = str(tmp_path)
    land(spark, path, 1, range(200))
    write_kafka(kafka(spark, [record(framed(1, 1, "x"))]), {"className": "D", "path": path, "id": "n"}, SCHEMAS)
    compact(spark, path, "C")
    stored = spark.read.parquet(f"{path}/_snapshots/class=C/objects/version=1")
    pieces = [[r["id"] for r in p] for p in stored.rdd.glom().collect() if p]
    assert all(p == sorted(p) for p in pieces) and sum(map(len, pieces)) == 200
    assert objects(read_compacted(spark, path, "D")) == {("1", "x")}
    with pytest.raises(ValueError):
        read_compacted(spark, path, "a/b")


def test_covered_batches_are_not_read(spark, tmp_path):
    path = str(tmp_path)
    for batch in range(3):
        land(spark, path, batch, range(batch, 40))
    compact(spark, path, "C")
    land(spark, path, 9, [3])
    read = read_compacted(spark, path, "C")
    read.collect()
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
