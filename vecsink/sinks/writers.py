"""One call from a Kafka-shaped table to stored or sent objects, in one pass over the table."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.functions.avro import Schemas
from vecsink.operators.delivery import FAILED, REJECTED, SENT, STORED, Transport, send_rows
from vecsink.operators.envelope import REJECT, parse_envelope
from vecsink.operators.objects import to_wire
from vecsink.plans.object_plan import plan_objects
from vecsink.plans.options import SinkOptions
from vecsink.sources.collection import store_batch
from vecsink.sources.registry import load_registry, prune_registry, registry_schemas


def load_schemas(df: DataFrame, options: SinkOptions) -> Schemas:
    """Schemas of the ids that the records of a table use."""
    if options.registry is None:
        raise ValueError("option registry is required when no schemas are given")
    return registry_schemas(prune_registry(load_registry(df.sparkSession, options.registry), parse_envelope(df)), set_aside=True)


def sent_rows(rows: DataFrame, options: SinkOptions, transport: Transport) -> DataFrame:
    """Objects in sent form with what became of each; rejects among them pass through."""
    wired = to_wire(rows)
    aside = F.when(F.col(REJECT).isNotNull(), REJECTED) if REJECT in rows.columns else F.lit(None).cast("string")
    return send_rows(wired.withColumn("outcome", aside), transport, options.delivery, options.on_error == "collect", options.transport_options)


def write_objects(rows: DataFrame, options: SinkOptions, transport: Transport | None, run: str, batch_id: int) -> None:
    """Objects, and rejects where the rows have some, sent or stored by one job.

    Each row leaves the job with an outcome, and Spark's writer stores them as folders of one batch, which it
    commits together. Without a path what was sent is not stored.
    """
    several = REJECT in rows.columns
    if transport is None:
        outcome = F.when(F.col(REJECT).isNotNull(), REJECTED).otherwise(STORED) if several else F.lit(STORED)
        told, possible = rows.withColumn("outcome", outcome), [STORED]
    else:
        told, possible = sent_rows(rows, options, transport), [SENT, *([FAILED] if options.on_error == "collect" else [])]
    if options.path is None:
        told.write.format("noop").mode("overwrite").save()
    else:
        store_batch(told, options.path, options.class_name, run, batch_id, possible + ([REJECTED] if several else []))


def send_objects(objects: DataFrame, options: Mapping[str, object], transport: Transport, batch_id: int | None = None) -> None:
    """Send an object frame; with option `path` what was sent, and with `onError=collect` what was not, is stored there."""
    parsed = SinkOptions.parse(options)
    write_objects(objects, parsed, transport, parsed.run or "load", time.time_ns() if batch_id is None else batch_id)


def write_kafka(
    kafka: DataFrame,
    options: Mapping[str, object],
    schemas: Schemas | None = None,
    transport: Transport | None = None,
    mode: str = "append",
    batch_id: int | None = None,
) -> None:
    """Decode, build and write a Kafka-shaped table, in one pass.

    With a transport the objects are sent, otherwise they are stored; option `path` says where. Without option
    `keepRejects` the first record that cannot be decoded fails the job; with it such records are stored beside the
    objects, by the same job.
    """
    if mode != "append":
        raise ValueError("objects are only appended; use mode='append'")
    parsed = SinkOptions.parse(options)
    if transport is None and parsed.path is None:
        raise ValueError("give a transport or option path")
    plan = plan_objects(kafka, load_schemas(kafka, parsed) if schemas is None else schemas, parsed)
    rows = plan.outcomes() if parsed.keep_rejects else plan.objects(strict=True)
    write_objects(rows, parsed, transport, parsed.run or "load", time.time_ns() if batch_id is None else batch_id)
