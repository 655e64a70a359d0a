"""Structured Streaming runs: micro-batch callback and native stream sink."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vecsink.functions.avro import Schemas
from vecsink.operators.delivery import Transport, accept_all
from vecsink.plans.object_plan import plan_objects
from vecsink.plans.options import SinkOptions
from vecsink.plans.variant_plan import plan_variant_objects
from vecsink.sinks.writers import load_schemas, sent_rows, write_objects
from vecsink.sources.collection import batch_totals, read_rejects
from vecsink.sources.schema_lookup import SchemaFolder, lookup_folder

#: The property that Spark sets on the tasks of a micro-batch.
STREAM_BATCH = "streaming.sql.batchId"


@dataclass
class StreamTotals:
    """Rows seen and rejected by a run. Only the last micro-batch is kept, which a replay replaces."""

    rows: int = 0
    rejected: int = 0
    last: tuple[int, int, int] | None = None

    def record(self, batch_id: int, rows: int, rejected: int) -> None:
        if self.last is not None and self.last[0] == batch_id:
            self.rows -= self.last[1]
            self.rejected -= self.last[2]
        self.rows += rows
        self.rejected += rejected
        self.last = (batch_id, rows, rejected)


def stored_totals(spark: SparkSession, options: SinkOptions) -> StreamTotals:
    """Totals of what earlier starts of a run have stored, so that a restart goes on counting."""
    totals = StreamTotals()
    if options.path is None:
        return totals
    counts: dict[int, list[int]] = {}
    try:
        found = batch_totals(spark, options.path, options.class_name, options.run)
        top = found.agg(F.sum("rows").alias("rows"), F.max_by(F.struct("batch_id", "rows"), "batch_id").alias("last")).first()
    except AnalysisException:  # nothing stored yet
        top = None
    if top is not None and top["last"] is not None:
        totals.rows = top["rows"]
        counts[top["last"]["batch_id"]] = [top["last"]["rows"], 0]
    if options.keep_rejects:
        try:
            rejects = read_rejects(spark, options.path, options.class_name).where(F.col("run") == options.run)
            found = rejects.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
            top = found.agg(F.sum("n").alias("n"), F.max_by(F.struct("batch_id", "n"), "batch_id").alias("last")).first()
        except AnalysisException:  # nothing stored yet
            top = None
        if top is not None and top["last"] is not None:
            totals.rows += top["n"]
            totals.rejected = top["n"]
            counts.setdefault(top["last"]["batch_id"], [0, 0])[1] = top["last"]["n"]
    if counts:
        last = max(counts)
        totals.last = (last, sum(counts[last]), counts[last][1])
    return totals


@dataclass
class StreamRun:
    query: StreamingQuery
    totals: StreamTotals

    def finish(self, seconds: float | None = None) -> StreamTotals:
        """Wait for the end, or for some seconds and then stop."""
        if seconds is None:
            self.query.awaitTermination()
        elif not self.query.awaitTermination(seconds):
            self.query.stop()
        return self.totals


def _trigger(seconds: float | None) -> dict:
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def _named(options: Mapping[str, object]) -> SinkOptions:
    parsed = SinkOptions.parse(options)
    if parsed.run is None:
        raise ValueError("a stream needs option run, which names it across restarts")
    return parsed


def load_micro_batch(
    batch: DataFrame,
    batch_id: int,
    schemas: Schemas,
    options: Mapping[str, object],
    transport: Transport | None,
    totals: StreamTotals,
) -> None:
    """Write one micro-batch by one job; counting rides on it."""
    parsed = _named(options)
    plan = plan_objects(batch, schemas, parsed)
    seen = Observation()
    bad = F.count(F.when(F.col("reject_reason").isNotNull(), 1))
    plan = type(plan)(plan.decoded.observe(seen, F.count(F.lit(1)).alias("rows"), bad.alias("rejected")), plan.schemas, plan.options)
    write_objects(plan.outcomes() if parsed.keep_rejects else plan.objects(strict=True), parsed, transport, parsed.run, batch_id)
    counted = seen.get
    totals.record(batch_id, counted["rows"], counted["rejected"])


def run_stream(
    kafka: DataFrame,
    options: Mapping[str, object],
    checkpoint: str,
    schemas: Schemas | None = None,
    transport: Transport | None = None,
    trigger_seconds: float | None = None,
) -> StreamRun:
    """Start a query that writes each micro-batch; without a trigger it ends by itself.

    Option `run` names the query and its folders, so that a restart from the
    checkpoint replays the last micro-batch onto itself. Without given schemas the registry
    is asked for each micro-batch's own ids, so new schema ids need no restart.
    """
    parsed = _named(options)
    if transport is None and parsed.path is None:
        raise ValueError("give a transport or option path")
    if schemas is None and parsed.registry is None:
        raise ValueError("option registry is required when no schemas are given")
    totals = stored_totals(kafka.sparkSession, parsed)

    def load(batch: DataFrame, batch_id: int) -> None:
        current = load_schemas(batch, parsed) if schemas is None else schemas
        load_micro_batch(batch, batch_id, current, options, transport, totals)

    writer = kafka.writeStream.queryName(parsed.run).foreachBatch(load).option("checkpointLocation", checkpoint)
    return StreamRun(writer.trigger(**_trigger(trigger_seconds)).start(), totals)


def run_native_stream(
    kafka: DataFrame,
    options: Mapping[str, object],
    checkpoint: str,
    schemas: Schemas | None = None,
    transport: Transport = accept_all,
    trigger_seconds: float | None = None,
) -> StreamingQuery:
    """One streaming plan that decodes, sends and stores, without a call per micro-batch.

    Without given schemas each task looks up the schemas of the records that it meets, so the plan does not
    depend on them and a schema that is registered later is found while the query runs. With option `path`
    Spark's file sink stores what was sent, in a folder per micro-batch; without it nothing is stored.
    """
    parsed = _named(options)
    if parsed.keep_rejects:
        raise ValueError("the native sink is strict; use run_stream to keep rejects")
    spark = kafka.sparkSession
    if schemas is None:
        if parsed.registry is None:
            raise ValueError("option registry is required when no schemas are given")
        source = SchemaFolder(lookup_folder(spark, parsed.registry, f"{checkpoint}/schemas"))
        plan = plan_variant_objects(kafka, source, parsed)
    else:
        plan = plan_objects(kafka, schemas, parsed)
    sent = sent_rows(plan.objects(strict=True), parsed, transport).withColumn("written_at", F.current_timestamp())
    if parsed.path is None:
        writer = sent.writeStream.format("noop")
    else:
        stored = sent.drop("class").withColumn("batch_id", _micro_batch()("id"))
        folder = f"{parsed.path.rstrip('/')}/class={parsed.class_name}/run={parsed.run}"
        writer = stored.writeStream.format("parquet").option("path", folder).partitionBy("batch_id", "outcome")
    writer = writer.queryName(parsed.run).option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(**_trigger(trigger_seconds)).start()


def _micro_batch():
    """The number of the micro-batch that a task belongs to."""

    @F.arrow_udf("bigint")
    def number(ids: pa.Array) -> pa.Array:
        current = int(TaskContext.get().getLocalProperty(STREAM_BATCH))
        return pa.repeat(pa.scalar(current, pa.int64()), len(ids))

    return number.asNondeterministic()
