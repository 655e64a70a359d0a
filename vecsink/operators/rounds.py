"""Retries in rounds: objects that failed wait in a table with the time at which they are due, and no task sleeps.

A round is one job. It sends what is due once, and stores every object that came in by what became of it:
`<folder>/round=<n>/status=<sent|failed|waiting>`. The next round reads only what waits. A round that
runs again, with its number, replaces itself and sends the same objects again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecsink.operators.delivery import FAILED, OBJECT, SENT, Delivery, Pieces, Transport, _ask, last_per_id, opened
from vecsink.operators.objects import to_wire

WAITING = "waiting"
_COLUMNS = (*OBJECT, "attempt", "due", "status", "error")
_SCHEMA = "class string, id string, vector array<float>, properties string, attempt int, due timestamp, status string, error string"
_DUE = pa.timestamp("us", "UTC")


def _sent(batch: pa.RecordBatch, transport: Transport, how: Delivery, now: dt.datetime) -> pa.RecordBatch:
    """One request for objects of one attempt; what fails waits twice as long as the time before."""
    batch = last_per_id(batch)
    attempt = batch.column("attempt")[0].as_py() + 1
    error, _ = _ask(transport, batch.select(list(OBJECT)), attempt)
    again = WAITING if attempt <= how.retries else FAILED
    due = now + dt.timedelta(seconds=how.backoff * 2 ** (attempt - 1)) if again == WAITING else None
    count, took = batch.num_rows, error.is_null()
    status = pc.if_else(took, SENT, again)
    when = pc.if_else(took, pa.scalar(None, _DUE), pa.scalar(due, _DUE))
    parts = [*(batch.column(n) for n in OBJECT), pa.repeat(pa.scalar(attempt, pa.int32()), count), when, status, error]
    return pa.RecordBatch.from_arrays(parts, list(_COLUMNS))


def run_round(
    spark: SparkSession,
    folder: str,
    number: int,
    transport: Transport,
    how: Delivery,
    now: dt.datetime,
    objects: DataFrame | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Send what is due at `now`: what waits after the round before, and new `objects` if there are any.

    `now` has a time zone. Objects of one attempt are sent together, `batch_size` at a time. An object that failed is due again
    after `backoff` seconds, then twice, four times and so on, and fails for good after `retries` resends. An object that is
    not due goes on as it is. Give one object per id: one that waits would otherwise be sent after a newer one.
    """
    if now.tzinfo is None:
        raise ValueError("the time of a round needs a time zone")
    if number < 0 or (number == 0 and objects is None):
        raise ValueError("the first round is number 0 and needs objects")
    due = None
    if objects is not None:
        due = to_wire(objects).select(*OBJECT, F.lit(0).alias("attempt"), F.lit(None).cast("timestamp").alias("due"), F.lit(WAITING).alias("status"), F.lit(None).cast("string").alias("error"))
    if number > 0:
        before = spark.read.schema(f"{_SCHEMA}, round int").option("basePath", folder).parquet(f"{folder}/round={number - 1}")
        waiting = before.where(F.col("status") == WAITING).select(*_COLUMNS)
        due = waiting if due is None else waiting.unionByName(due)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, Pieces] = {}
        with opened(transport, options or {}) as ready:
            for batch in batches:
                is_due = pc.fill_null(pc.less_equal(batch.column("due"), pa.scalar(now, _DUE)), True)
                later = batch.filter(pc.invert(is_due))
                if later.num_rows:
                    yield later
                batch = batch.filter(is_due)
                for attempt in pc.unique(batch.column("attempt")).to_pylist():
                    held = pieces.setdefault(attempt, Pieces(how.batch_size))
                    for piece in held.add(batch.filter(pc.equal(batch.column("attempt"), attempt))):
                        yield _sent(piece, ready, how, now)
            for held in pieces.values():
                for piece in held.rest():
                    yield _sent(piece, ready, how, now)

    told = due.mapInArrow(send, _SCHEMA)
    told.write.mode("overwrite").partitionBy("status").parquet(f"{folder}/round={number}")


def read_rounds(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """Every object after a round: sent or failed in that or an earlier one, or waiting, with `round`, `attempt` and `due`."""
    rows = spark.read.schema(f"{_SCHEMA}, round int").parquet(folder)
    return rows.where((F.col("round") <= number) & ((F.col("status") != WAITING) | (F.col("round") == number)))
