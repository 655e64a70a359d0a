import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecsink.operators import delivery
from vecsink.operators.delivery import Delivery, last_per_id, send_with_retry, slice_batches
from vecsink.plans.options import SinkOptions


def batch(ids, properties=None):
    count = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(["C"] * count), pa.array(ids), pa.nulls(count, pa.list_(pa.float32())),
         pa.array(properties or ["{}"] * count)],
        names=["class", "id", "vector", "properties"],
    )


@pytest.mark.parametrize("sizes, size", [([3, 4, 5], 5), ([12], 5), ([1] * 7, 3), ([0, 0], 2), ([], 2), ([10], 5), ([2], 9)])
def test_slices_keep_every_row_in_order(sizes, size):
    ids = iter(range(1000))
    batches = [batch([str(next(ids)) for _ in range(n)]) for n in sizes]
    cut = list(slice_batches(batches, size))
    assert [i for b in cut for i in b.column("id").to_pylist()] == [str(i) for i in range(sum(sizes))]
    assert all(b.num_rows == size for b in cut[:-1]) and all(0 < b.num_rows <= size for b in cut)


def test_last_per_id():
    kept = last_per_id(batch(["a", "b", "a", "c", "b"], ["1", "2", "3", "4", "5"]))
    assert kept.column("properties").to_pylist() == ["3", "4", "5"]
    same = batch(["a", "b"])
    assert last_per_id(same) is same


def test_only_failed_objects_are_sent_again():
    calls, pauses = [], []

    def transport(part, attempt):
        calls.append((attempt, part.column("id").to_pylist()))
        return [None if i == "ok" or attempt > int(i) else f"no {attempt}" for i in part.column("id").to_pylist()]

    got = send_with_retry(batch(["ok", "1", "2", "3"]), transport, Delivery(10, 2, 7), pauses.append)
    assert calls == [(1, ["ok", "1", "2", "3"]), (2, ["1", "2", "3"]), (3, ["2", "3"])]
    assert got.to_pylist() == [
        {"id": "ok", "attempt": 1, "status": "sent", "error": None},
        {"id": "1", "attempt": 2, "status": "sent", "error": None},
        {"id": "2", "attempt": 3, "status": "sent", "error": None},
        {"id": "3", "attempt": 3, "status": "failed", "error": "no 3"},
    ]
    assert pauses == []


def test_failed_request_waits_and_resends_all():
    pauses = []

    def transport(part, attempt):
        if attempt < 3:
            raise ConnectionError("down")
        return pa.nulls(part.num_rows)

    got = send_with_retry(batch(["a", "b"]), transport, Delivery(10, 2, 7), pauses.append)
    assert got.column("status").to_pylist() == ["sent", "sent"] and got.column("attempt").to_pylist() == [3, 3]
    assert pauses == [7, 7]
    got = send_with_retry(batch(["a"]), transport, Delivery(10, 1, 7), pauses.append)
    assert got.to_pylist() == [{"id": "a", "attempt": 2, "status": "failed", "error": "down"}]


def test_no_retries_and_short_answers():
    got = send_with_retry(batch(["a", "b"]), lambda b, n: ["e", None], Delivery(10, 0, 0))
    assert got.column("status").to_pylist() == ["failed", "sent"] and got.column("attempt").to_pylist() == [1, 1]
    with pytest.raises(ValueError, match="answered for 1 of 2"):
        send_with_retry(batch(["a", "b"]), lambda b, n: [None], Delivery(10, 0, 0))


def objects(spark, count=1000):
    return spark.range(count, numPartitions=3).select(
        F.lit("C").alias("class"),
        F.col("id").cast("string").alias("id"),
        F.lit(None).cast("array<float>").alias("vector"),
        F.struct(F.col("id").alias("n")).alias("properties"),
    )


def test_transport_with_client_gets_options(spark):
    def refuse(options):
        return lambda part, attempt: [options["prefix"] + i for i in part.column("id").to_pylist()]

    class Opened:
        open = staticmethod(refuse)

    got = delivery.deliver(objects(spark, 5), Opened(), Delivery(2, 0, 0), {"prefix": "p"}).collect()
    assert sorted(r["error"] for r in got) == ["p0", "p1", "p2", "p3", "p4"]


def test_outcome_table_and_what_remains(spark):
    def transport(part, attempt):
        return [("odd" if int(i) % 2 else None) for i in part.column("id").to_pylist()]

    outcomes = delivery.deliver(objects(spark), transport, Delivery(64, 1, 0))
    assert delivery.succeeded(outcomes).count() == 500 and delivery.failures(outcomes).count() == 500
    left = delivery.remaining(objects(spark), outcomes)
    assert {int(r["id"]) % 2 for r in left.collect()} == {1} and left.count() == 500


def test_option_keys_in_any_case():
    options = SinkOptions.parse({
        "CLASSNAME": "Clickstream", "batchsize": "200", "Vector": "v", "ID": "i", "Retries": 5, "retriesbackoff": "1.5",
        "schemaRegistryUrl": "registry_table", "schemaregistryapikey": "KEY", "SCHEMAREGISTRYAPISECRET": "SECRET",
        "host": "db:8080", "scheme": "http", "header:X-Token": "t", "oidc:username": "u", "timeout": 60,
    })
    assert (options.class_name, options.batch_size, options.vector, options.id) == ("Clickstream", 200, "v", "i")
    assert options.delivery == Delivery(200, 5, 1.5)
    assert (options.schema_registry_url, options.schema_registry_api_key, options.schema_registry_api_secret) == (
        "registry_table", "KEY", "SECRET")
    assert options.registry == "registry_table"
    assert options.transport_options == {
        "host": "db:8080", "scheme": "http", "header:x-token": "t", "oidc:username": "u", "timeout": "60"}


@pytest.mark.parametrize(
    "bad",
    [{}, {"className": "C", "batchSize": 0}, {"className": "C", "retries": -1}, {"className": "C", "onError": "x"},
     {"className": "C", "onError": "collect"}],
)
def test_bad_options(bad):
    with pytest.raises(ValueError):
        SinkOptions.parse(bad)
