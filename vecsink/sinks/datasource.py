"""The `vecsink` data source: object frames go to a transport.

Each task cuts its rows into batches, sends them and resends what failed. It stores nothing: to keep what
was sent and what was not, use write_kafka or send_objects, which let Spark's own writer commit it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from vecsink.operators.delivery import OBJECT, DeliveryError, Transport, accept_all, last_per_id, opened, send_with_retry, slice_batches
from vecsink.plans.options import SinkOptions

FORMAT = "vecsink"


@dataclass
class Committed(WriterCommitMessage):
    """How many objects one task has sent."""

    sent: int


def check_objects(schema: StructType) -> None:
    if tuple(schema.names[:4]) != OBJECT:
        raise ValueError(f"this sink takes object frames with columns {OBJECT}; build them with to_objects")


class _Sender:
    """What the batch and the stream writer share. Sent objects stay sent; a task that runs again sends them again."""

    def __init__(self, options: SinkOptions, transport: Transport):
        self.options, self.transport = options, transport

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        count = 0
        with opened(self.transport, self.options.transport_options) as ready:
            for batch in slice_batches(iterator, self.options.batch_size):
                batch = last_per_id(batch).select(list(OBJECT))
                lost = send_with_retry(batch, ready, self.options.delivery).column("error").drop_null()
                if len(lost):
                    raise DeliveryError(f"{len(lost)} objects of a batch could not be sent, first error: {lost[0]}")
                count += batch.num_rows
        return Committed(count)


class BatchWriter(_Sender, DataSourceArrowWriter):
    pass


class StreamWriter(_Sender, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        """Nothing is left to do: objects are stored by id when they are sent."""

    def abort(self, messages: list, batchId: int) -> None:
        """What was sent stays sent; the micro-batch runs again and sends the same ids."""


class ObjectSink(DataSource):
    """Write only, append only."""

    transport: Transport | None = None

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _checked(self, schema: StructType, overwrite: bool) -> tuple[SinkOptions, Transport]:
        if overwrite:
            raise ValueError("this sink only appends; use mode('append')")
        check_objects(schema)
        options = SinkOptions.parse(self.options)
        if options.path is not None or options.on_error == "collect":
            raise ValueError("the format only sends; write_kafka and send_objects store what was sent")
        if type(self).transport is None:
            raise ValueError("register the sink with a transport")
        return options, type(self).transport

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return BatchWriter(*self._checked(schema, overwrite))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return StreamWriter(*self._checked(schema, overwrite))


def register_sink(spark: SparkSession, transport: Transport = accept_all) -> str:
    """Make the format known to the session, with a transport; return its name."""
    chosen = transport

    class Sink(ObjectSink):
        transport = staticmethod(chosen)

    spark.dataSource.register(Sink)
    return FORMAT
