"""Numbering by sparse orders, gaps of offsets, merged spans and starts by time, against plain counts."""

import datetime as dt
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from vecsink.operators import numbering, offsets

SHAPE = "topic string, partition int, offset bigint"


def sparse_rows():
    rng = random.Random(3)
    hot = [("hot", rng.randrange(-(2**62), 2**62)) for _ in range(800)]
    rows = hot + [("cold", rng.randrange(2**62)) for _ in range(150)] + [(None, rng.randrange(50, 10**12)) for _ in range(50)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("ranges", [None, 1, 7, 40])
def test_sparse_positions_equal_a_plain_count(spark, ranges):
    rows = sparse_rows()
    placed = numbering.with_sparse_position(spark.createDataFrame(rows, "k string, o bigint"), ["k"], "o", "p", ranges)
    expected = {}
    for key in {k for k, _ in rows}:
        expected |= {(key, o): i for i, o in enumerate(sorted(o for k, o in rows if k == key))}
    assert {(r["k"], r["o"]): r["p"] for r in placed.collect()} == expected


def test_a_hot_key_is_spread_over_ranges(spark, tmp_path):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 5 == 0, "cold").otherwise("hot").alias("k"), (F.col("id") * F.col("id") * 104729).alias("o")
    )
    path = str(tmp_path / "numbered")
    placed = numbering.assign_sparse_batches(rows, 100, ["k"], "o", 16, path)
    sizes = placed.groupBy("k", "batch_no").count()
    assert sizes.where("count <> 100").count() == 0 and sizes.count() == 1000
    tasks = sorted(r["count"] for r in spark.read.parquet(path).groupBy(F.shiftright("_row", 33)).count().collect())
    assert len(tasks) >= 15 and tasks[-1] <= 3 * tasks[len(tasks) // 2]


def test_sparse_order_may_be_text_null_or_tied(spark):
    frame = spark.createDataFrame([("a", "x"), ("a", None), ("a", "x"), ("a", "b"), ("b", "q")], "k string, o string")
    placed = numbering.with_sparse_position(frame, ["k"], "o", "p", 3).collect()
    assert sorted((r["k"], r["p"]) for r in placed) == [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("b", 0)]
    assert {r["p"] for r in placed if r["o"] == "x"} == {2, 3}
    assert numbering.with_sparse_position(frame.where("false"), ["k"], "o", "p").collect() == []
    with pytest.raises(ValueError):
        numbering.assign_sparse_batches(frame, 0, ["k"], "o")
    with pytest.raises(ValueError):
        numbering.with_sparse_position(frame, ["k"], "o", "p", 0)


def plain_gaps(present, start, end):
    missing = [o for o in range(start, end) if o not in present]
    runs = [[v for _, v in g] for _, g in groupby(enumerate(missing), lambda p: p[1] - p[0])]
    return {(r[0], r[-1], len(r)) for r in runs}


def gaps_of(frame, **given):
    return {tuple(r) for r in offsets.offset_gaps(frame, **given).collect()}


def test_gaps_equal_a_plain_search(spark):
    rng = random.Random(9)
    size = 1 << offsets.BUCKET_BITS
    zero = set(rng.sample(range(-50, 3 * size), 2 * size))
    zero -= set(range(size - 20, size + 20))
    rows = [("t", 0, o) for o in zero] + [("t", 0, min(zero))] * 5
    rows += [("t", 1, o) for o in (3, 4, 2**40, 2**40 + 2)] + [("u", None, 7), ("u", None, 9), ("u", 3, None)]
    expected = {("t", 0, *g) for g in plain_gaps(zero, min(zero), max(zero))}
    expected |= {("t", 1, 5, 2**40 - 1, 2**40 - 5), ("t", 1, 2**40 + 1, 2**40 + 1, 1), ("u", None, 8, 8, 1)}
    assert gaps_of(spark.createDataFrame(rows, SHAPE)) == expected


def test_gaps_at_the_ends_and_of_whole_partitions(spark):
    whole = spark.createDataFrame([("t", 0, 0, 10), ("t", 1, 5, 9), ("t", 2, 4, 4), ("t", 3, 0, 2)], "topic string, partition int, start bigint, end bigint")
    frame = spark.createDataFrame([("t", 0, 2), ("t", 0, 3), ("t", 3, 0), ("t", 3, 1)], SHAPE)
    assert gaps_of(frame, expected=whole) == {("t", 0, 0, 1, 2), ("t", 0, 4, 9, 6), ("t", 1, 5, 8, 4)}
    assert gaps_of(frame.where("false")) == set()


def test_loss_is_refused(spark):
    offsets.refuse_loss(spark.createDataFrame([("t", 0, 1), ("t", 0, 2)], SHAPE))
    with pytest.raises(offsets.DataLossError, match="4 offsets are missing in 2 gaps"):
        offsets.refuse_loss(spark.createDataFrame([("t", 0, 1), ("t", 0, 3), ("t", 0, 7)], SHAPE))


def test_spans_are_merged_across_buckets(spark):
    size = 1 << offsets.BUCKET_BITS
    spans = [("a", 0, 4), ("a", 5, 5), ("a", 7, size - 1), ("a", size, size + 3), ("a", 9, 12), ("b", 2**31 - 1, 2**31 + 5), ("b", 2**31 + 6, 2**33), (None, 1, 1)]
    merged = offsets.merge_spans(spark.createDataFrame(spans, "k string, first_offset bigint, last_offset bigint"), ["k"])
    assert {tuple(r) for r in merged.collect()} == {("a", 0, 5), ("a", 7, size + 3), ("b", 2**31 - 1, 2**33), (None, 1, 1)}


def test_a_start_by_time_is_an_offset(spark):
    times = [(0, 1, 10), (0, 2, 30), (0, 3, 20), (1, 1, 5), (None, 4, 25)]
    rows = [("t", p, o, dt.datetime(2024, 1, 1, 0, s)) for p, o, s in times]
    frame = spark.createDataFrame(rows, f"{SHAPE}, timestamp timestamp")
    later = offsets.start_at(frame, F.lit(dt.datetime(2024, 1, 1, 0, 25)))
    assert {(r["partition"], r["offset"]) for r in later.collect()} == {(0, 2), (0, 3), (None, 4)}
