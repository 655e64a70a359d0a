import random

import pytest
from pyspark.sql import functions as F

from vecsink.operators.batching import assign_batches, keep_last, with_position

SHAPE = "topic string, partition int, offset bigint"


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def hot_rows():
    """One partition holds most rows; offsets have gaps; keys may be null."""
    rng = random.Random(5)
    rows = [("t", 0, o) for o in sorted(rng.sample(range(5000), 900))]
    rows += [("t", 1, o) for o in range(10, 60)] + [("u", 0, 7), ("u", 0, -3)]
    rows += [(None, None, o) for o in range(5)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [3, 6, 17])
def test_positions_equal_a_plain_count(spark, bits):
    rows = hot_rows()
    placed = with_position(spark.createDataFrame(rows, SHAPE), ["topic", "partition"], "offset", "p", bits)
    expected = {}
    for topic, partition, offset in rows:
        expected[(topic, partition, offset)] = sum(1 for t, p, o in rows if (t, p) == (topic, partition) and o < offset)
    assert {tuple(r)[:3]: r["p"] for r in placed.collect()} == expected


def test_copies_of_an_offset_are_all_kept(spark):
    frame = spark.createDataFrame([("t", 0, 5)] * 40 + [("t", 0, 1), ("t", 0, 9)], SHAPE)
    placed = with_position(frame, ["topic", "partition"], "offset", "p", 2)
    assert sorted(r["p"] for r in placed.collect()) == list(range(42))
    assert {r["p"] for r in placed.where("offset <> 5").collect()} == {0, 41}


def test_batches_have_the_size_and_the_rest(spark):
    batches = assign_batches(spark.createDataFrame(hot_rows(), SHAPE), 200, bucket_bits=4)
    sizes = {
        (r["topic"], r["partition"], r["batch_no"]): r["n"]
        for r in batches.groupBy("topic", "partition", "batch_no").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert [sizes[("t", 0, b)] for b in range(5)] == [200, 200, 200, 200, 100]
    assert sizes[("t", 1, 0)] == 50 and sizes[("u", 0, 0)] == 2 and sizes[(None, None, 0)] == 5
    with pytest.raises(ValueError):
        assign_batches(batches, 0)


def test_a_hot_partition_is_spread_over_buckets(spark):
    rows = spark.range(100_000).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("x").alias("value")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = assign_batches(rows, 100, bucket_bits=10)
        assert placed.where("batch_no <> offset div 100").count() == 0
        tasks = placed.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 60_000


def test_keep_last(spark):
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "w"), (None, 1, "n"), (None, 2, "m")]
    frame = spark.createDataFrame(rows, "id string, o int, v string")
    assert {(r["id"], r["v"]) for r in keep_last(frame, ["id"], [F.col("o")]).collect()} == {
        ("a", "z"), ("b", "w"), (None, "m")}


def test_keep_last_cuts_hot_keys_before_the_shuffle(spark):
    frame = spark.range(1000, numPartitions=4).select((F.col("id") % 2).alias("id"), F.col("id").alias("o"))
    text = plan_of(keep_last(frame, ["id"], [F.col("o")]))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Exchange") < text.index("Partial")
