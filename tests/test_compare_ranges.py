"""Ranges that differ, against a plain comparison of bags."""

import random
from collections import Counter

import pytest

from vecsink.operators.compare_ranges import differing_ranges

SHAPE = "topic string, partition int, offset bigint, v string, w string"


def plain(source, stored):
    faults = {}
    for place in {r[:3] for r in source + stored}:
        a, b = (Counter(r[3:] for r in side if r[:3] == place) for side in (source, stored))
        if a == b:
            continue
        n, m = a.total(), b.total()
        faults[place] = "missing" if not m else "extra" if not n else "doubled" if m > n else "lost_copy" if m < n else "changed"
    return faults


def offsets_of(frame):
    out = {}
    for r in frame.collect():
        for at in range(r["first_offset"], r["last_offset"] + 1) if r["first_offset"] is not None else [None]:
            assert (r["topic"], r["partition"], at) not in out
            out[(r["topic"], r["partition"], at)] = r["fault"]
    return out


def damaged(seed):
    rng = random.Random(seed)
    source = [("t", p, o, rng.choice("ab"), rng.choice(["x", None])) for p in (0, 1, None) for o in range(-20, 400)]
    source += rng.sample(source, 60)
    stored = []
    for row in source:
        kind = rng.random()
        if kind < 0.04:
            continue
        if kind < 0.08:
            row = (*row[:3], row[4], row[3])
        stored += [row] * (2 if kind > 0.96 else 1)
    stored += [("t", 0, 10**12 + i, "a", None) for i in range(3)] + [("u", 9, 5, "a", "b")]
    rng.shuffle(stored)
    return source, stored


@pytest.mark.parametrize("levels", [(24, 14, 0), (5, 0), (0,)])
def test_ranges_equal_a_plain_comparison(spark, levels):
    source, stored = damaged(len(levels))
    found = differing_ranges(spark.createDataFrame(source, SHAPE), spark.createDataFrame(stored, SHAPE), ["v", "w"], level_bits=levels)
    assert offsets_of(found) == plain(source, stored)


def test_neighbours_are_one_range(spark):
    source = [("t", 0, o, "a", "b") for o in range(100_000)]
    stored = [r for r in source if not 30_000 <= r[2] <= 70_000]
    found = differing_ranges(spark.createDataFrame(source, SHAPE), spark.createDataFrame(stored, SHAPE), ["v", "w"])
    assert [tuple(r) for r in found.collect()] == [("t", 0, "missing", 30_000, 70_000)]


def test_equal_and_empty_tables_do_not_differ(spark):
    rows = spark.createDataFrame([("t", 0, 1, "a", None), ("t", 0, None, None, None), (None, None, 1, "a", "b")], SHAPE)
    assert differing_ranges(rows, rows.orderBy("v"), ["v", "w"]).count() == 0
    assert differing_ranges(rows.where("false"), rows.where("false"), ["v"]).count() == 0
    assert differing_ranges(rows, rows.where("offset IS NOT NULL"), ["v"]).first()["fault"] == "missing"
    with pytest.raises(ValueError):
        differing_ranges(rows, rows, ["v"], level_bits=(4, 2))


def test_only_fingerprints_are_shuffled(spark):
    from vecsink.operators import compare_ranges as c

    rows = spark.range(100_000).selectExpr("'t' topic", "0 partition", "id offset", "cast(id as string) v")
    sides = [c._hashed(rows, ["topic", "partition"], "offset", ["v"])] * 2
    both = c._both(*sides, ["topic", "partition"], 14)
    both.collect()
    plan = both._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.index("Exchange") < final.rindex("HashAggregate")
    assert "Join" not in final
