"""Retries in rounds: attempts, due times and what is read again."""

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecsink.operators.delivery import Delivery
from vecsink.operators.rounds import read_rounds, run_round

START = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
HOUR = Delivery(batch_size=3, retries=2, backoff=3600)


def objects(spark, first, last):
    return spark.range(first, last, numPartitions=2).select(
        F.lit("C").alias("class"), F.col("id").cast("string").alias("id"), F.lit(None).cast("array<float>").alias("vector"), F.lit("{}").alias("properties")
    )


def numbered():
    """A transport by which object n works at attempt n + 1; a request that holds 7 fails as a whole at its first attempt."""

    def send(batch, attempt):
        ids = [int(i) for i in batch.column("id").to_pylist()]
        if 7 in ids and attempt == 1:
            raise RuntimeError("down")
        return pa.array([None if attempt > n % 4 else f"no {attempt}" for n in ids], pa.string())

    return send


by_number = numbered()


def state(spark, folder, number):
    return {int(r["id"]): (r["round"], r["attempt"], r["status"]) for r in read_rounds(spark, folder, number).collect()}


def test_rounds_send_only_what_is_due(spark, tmp_path):
    folder = str(tmp_path)
    run_round(spark, folder, 0, by_number, HOUR, START, objects(spark, 0, 4))
    assert state(spark, folder, 0) == {0: (0, 1, "sent"), **{n: (0, 1, "waiting") for n in (1, 2, 3)}}
    # Nothing of the first is due after a minute; new objects are.
    run_round(spark, folder, 1, by_number, HOUR, START + dt.timedelta(minutes=1), objects(spark, 4, 5))
    assert state(spark, folder, 1) == {0: (0, 1, "sent"), 4: (1, 1, "sent"), **{n: (1, 1, "waiting") for n in (1, 2, 3)}}
    for again in range(2):
        run_round(spark, folder, 2, by_number, HOUR, START + dt.timedelta(hours=1))
        assert state(spark, folder, 2)[1] == (2, 2, "sent") and state(spark, folder, 2)[3] == (2, 2, "waiting"), again
    due = {r["due"] for r in read_rounds(spark, folder, 2).where("status = 'waiting'").select(F.unix_seconds("due").alias("due")).collect()}
    assert due == {int(START.timestamp()) + 3 * 3600}
    run_round(spark, folder, 3, by_number, HOUR, START + dt.timedelta(hours=3))
    assert state(spark, folder, 3) == {0: (0, 1, "sent"), 1: (2, 2, "sent"), 2: (3, 3, "sent"), 3: (3, 3, "failed"), 4: (1, 1, "sent")}
    run_round(spark, folder, 4, by_number, HOUR, START + dt.timedelta(hours=9))
    assert state(spark, folder, 4) == state(spark, folder, 3)


def test_a_request_that_fails_makes_all_its_objects_wait(spark, tmp_path):
    run_round(spark, str(tmp_path), 0, by_number, HOUR, START, objects(spark, 6, 9).coalesce(1))
    rows = read_rounds(spark, str(tmp_path), 0).collect()
    assert {(r["status"], r["error"]) for r in rows} == {("waiting", "down")} and len(rows) == 3


def test_rounds_need_a_start_and_a_zone(spark, tmp_path):
    with pytest.raises(ValueError):
        run_round(spark, str(tmp_path), 0, by_number, HOUR, START)
    with pytest.raises(ValueError):
        run_round(spark, str(tmp_path), 1, by_number, HOUR, dt.datetime(2024, 1, 1))
