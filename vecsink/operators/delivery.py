"""Objects sent in batches through a transport, with one outcome per object.

A transport is a function `(batch, attempt) -> errors`: it gets an Arrow record
batch of `class, id, vector, properties` and the attempt number, and returns one
error text, or null, per object. Properties are JSON text; an object without a
vector has an empty one. It raises when the whole request fails. It must
store objects by id, because a task that Spark runs again sends its objects again.

A transport that needs a client has `open(options)`, called once per task; what
it returns is used as the transport and is closed at the end if it has `close`.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.operators.objects import to_wire

Transport = Callable[[pa.RecordBatch, int], "pa.Array | list"]

OUTCOME_SCHEMA = "id string, attempt int, status string, error string"
_OUTCOME_ARROW = pa.schema(
    [("id", pa.string()), ("attempt", pa.int32()), ("status", pa.string()), ("error", pa.string())]
)

# What became of an object.
SENT = "sent"
FAILED = "failed"
REJECTED = "rejected"
STORED = "stored"
OBJECT = ("class", "id", "vector", "properties")


class DeliveryError(RuntimeError):
    """Objects that could not be sent within the allowed retries."""


@dataclass(frozen=True)
class Delivery:
    """How to send: rows per batch, resends after a failure, seconds before one."""

    batch_size: int = 100
    retries: int = 2
    backoff: float = 2.0


def accept_all(batch: pa.RecordBatch, attempt: int) -> pa.Array:
    """A transport that takes every object."""
    return pa.nulls(batch.num_rows, pa.string())


@contextmanager
def opened(transport: Transport, options: Mapping[str, str]) -> Iterator[Transport]:
    """The transport ready for one task."""
    opener = getattr(transport, "open", None)
    ready = opener(dict(options)) if opener is not None else transport
    try:
        yield ready
    finally:
        closer = getattr(ready, "close", None)
        if opener is not None and closer is not None:
            closer()


class Pieces:
    """Regroups a task's rows into batches of a size; what is held is less than one."""

    def __init__(self, size: int):
        self.size, self.held, self.rows = size, [], 0

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = 0
        while self.rows + batch.num_rows - at >= self.size:
            take = self.size - self.rows
            yield _join([*self.held, batch.slice(at, take)])
            self.held, self.rows, at = [], 0, at + take
        if at < batch.num_rows:
            self.held.append(batch.slice(at))
            self.rows += batch.num_rows - at

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield _join(self.held)
        self.held, self.rows = [], 0


def slice_batches(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Regroup a task's rows into batches of `size`, the last one shorter."""
    pieces = Pieces(size)
    for batch in batches:
        yield from pieces.add(batch)
    yield from pieces.rest()


def _join(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def last_per_id(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Within one batch a later object replaces an earlier one of the same id."""
    ids = batch.column("id")
    if pc.count_distinct(ids, mode="all").as_py() == batch.num_rows:
        return batch
    last = {object_id: row for row, object_id in enumerate(ids.to_pylist())}
    return batch.take(pa.array(sorted(last.values())))


def send_with_retry(
    batch: pa.RecordBatch, transport: Transport, how: Delivery, sleep: Callable[[float], None] = time.sleep
) -> pa.RecordBatch:
    """Send one batch and resend only what failed, until it works or retries end.

    The pause comes before resending a failed request; objects that failed one
    by one are resent at once.
    """
    ids = batch.column("id").cast(pa.string())
    attempts = np.ones(batch.num_rows, dtype=np.int32)
    errors = np.full(batch.num_rows, None, dtype=object)
    pending = np.arange(batch.num_rows)
    for attempt in range(1, how.retries + 2):
        attempts[pending] = attempt
        part = batch if len(pending) == batch.num_rows else batch.take(pa.array(pending))
        answer, request_failed = _ask(transport, part, attempt)
        if answer.null_count == len(answer):
            errors[pending] = None
            break
        errors[pending] = answer.to_numpy(zero_copy_only=False)
        pending = pending[answer.is_valid().to_numpy(zero_copy_only=False)]
        if request_failed and attempt <= how.retries:
            sleep(how.backoff)
    error = pa.array(errors, pa.string())
    status = pc.if_else(error.is_null(), SENT, FAILED)
    return pa.RecordBatch.from_arrays([ids, pa.array(attempts), status, error], schema=_OUTCOME_ARROW)


def _ask(transport: Transport, batch: pa.RecordBatch, attempt: int) -> tuple[pa.Array, bool]:
    """Errors per object, and whether the request as a whole failed."""
    try:
        answer = transport(batch, attempt)
    except Exception as failure:  # any failure of the request counts as one attempt
        text = str(failure) or type(failure).__name__
        return pa.array([text] * batch.num_rows, pa.string()), True
    if isinstance(answer, pa.ChunkedArray):
        answer = answer.combine_chunks()
    answer = answer.cast(pa.string()) if isinstance(answer, pa.Array) else pa.array(answer, pa.string())
    if len(answer) != batch.num_rows:
        raise ValueError(f"transport answered for {len(answer)} of {batch.num_rows} objects")
    return answer, False


def deliver(
    objects: DataFrame, transport: Transport, how: Delivery = Delivery(), options: Mapping[str, str] | None = None
) -> DataFrame:
    """Send objects from the tasks that hold them; return the outcome table.

    Lazy like any frame: each action on the result sends again, so write the
    outcomes once and work from what was written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with opened(transport, options or {}) as ready:
            for batch in slice_batches(batches, how.batch_size):
                yield send_with_retry(last_per_id(batch), ready, how)

    return to_wire(objects).mapInArrow(run, OUTCOME_SCHEMA)


def send_rows(
    rows: DataFrame, transport: Transport, how: Delivery, collect: bool, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Send the rows of a wire frame that have no `outcome` yet; all rows come out, with `outcome`, `attempt` and `error`.

    Rows that have an outcome pass through. Without `collect` the first object that fails for good fails the
    task. Lazy like any frame: let one action write what comes out.
    """
    names = [n for n in rows.columns if n != "outcome"]

    def told(batch: pa.RecordBatch, outcome, attempt, error) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), outcome, attempt, error], [*names, "outcome", "attempt", "error"])

    def sent(batch: pa.RecordBatch, ready: Transport) -> pa.RecordBatch:
        batch = last_per_id(batch)
        done = send_with_retry(batch.select(list(OBJECT)), ready, how)
        lost = done.column("error").drop_null()
        if len(lost) and not collect:
            raise DeliveryError(f"{len(lost)} objects of a batch could not be sent, first error: {lost[0]}")
        return told(batch, done.column("status"), done.column("attempt"), done.column("error"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(how.batch_size)
        with opened(transport, options or {}) as ready:
            for batch in batches:
                settled = batch.column("outcome").is_valid()
                aside = batch.filter(settled)
                if aside.num_rows:
                    nothing = [pa.nulls(aside.num_rows, kind) for kind in (pa.int32(), pa.string())]
                    yield told(aside, aside.column("outcome"), *nothing)
                for piece in pieces.add(batch.filter(pc.invert(settled))):
                    yield sent(piece, ready)
            for piece in pieces.rest():
                yield sent(piece, ready)

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names)
    return rows.mapInArrow(run, f"{schema}, outcome string, attempt int, error string")


def succeeded(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status") == SENT)


def failures(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status") == FAILED)


def remaining(objects: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Objects without a successful outcome: what a later run has to send.

    Outcomes are reduced to ids before the join; at run time Spark broadcasts a
    small side and splits a hot id on the object side.
    """
    return objects.join(succeeded(outcomes).select("id").distinct(), "id", "left_anti")
