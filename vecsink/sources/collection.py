"""Stored objects: parquet folders by class, run and batch.

`<path>/class=<class>/run=<run>/batch_id=<n>/outcome=<outcome>/`. One write fills one batch
folder, and writing the same batch again replaces it. Objects that were stored or sent, objects that could not be
sent and records that were set aside are the outcomes of a batch; one job writes them all.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecsink.operators.batching import keep_last
from vecsink.operators.delivery import FAILED, REJECTED, SENT, STORED
from vecsink.operators.envelope import REJECT
from vecsink.operators.id_filter import key_filter, with_maybe

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_\-]*")


def batch_folder(path: str, class_name: str, run: str, batch_id: int) -> str:
    for name in (class_name, run):
        if not _NAME.fullmatch(name):
            raise ValueError(f"{name!r} cannot name a folder: use letters, digits, _ and -")
    return f"{path.rstrip('/')}/class={class_name}/run={run}/batch_id={int(batch_id)}"


def store_batch(rows: DataFrame, path: str, class_name: str, run: str, batch_id: int, outcomes: Sequence[str] = ()) -> None:
    """Rows with an `outcome` as the folder of one batch.

    Spark swaps the folders when the job commits, so a job that fails leaves what an earlier run of
    the batch has stored. Where a batch may have several outcomes, each gets a closing row without an id,
    so that a folder of an earlier run is replaced also if this run has nothing for it.
    """
    batch_folder(path, class_name, run, batch_id)
    stamped = rows.drop("class").withColumn("written_at", F.current_timestamp())
    if len(outcomes) > 1:
        closing = rows.sparkSession.range(len(outcomes), numPartitions=1).select(F.array(*map(F.lit, outcomes))[F.col("id").cast("int")].alias("outcome"))
        stamped = stamped.unionByName(closing.withColumn("written_at", F.current_timestamp()), allowMissingColumns=True)
    named = {"class": F.lit(class_name), "run": F.lit(run), "batch_id": F.lit(int(batch_id))}
    writer = stamped.withColumns(named).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*named, "outcome").parquet(path)


def _stored(reader: DataFrameReader, path: str, class_name: str | None) -> DataFrame:
    # Classes may have properties of one name and different types, so one class never reads another's.
    stored = reader.option("basePath", path).parquet(path if class_name is None else f"{path.rstrip('/')}/class={class_name}")
    names = {"class": "string", "run": "string", "batch_id": "bigint", "outcome": "string"}
    return stored.withColumns({name: F.col(name).cast(kind) for name, kind in names.items()})


def scan_collection(
    spark: SparkSession,
    path: str,
    class_name: str | None = None,
    schema: T.StructType | None = None,
    all_properties: bool = True,
) -> DataFrame:
    """Every stored row; of a named class only its own folder is read.

    Later batches may have more properties, so the footers of all files are
    merged, by a Spark job. A given schema, or no need of all properties, saves that.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema.add("outcome", "string") if "outcome" not in schema.names else schema)
    elif all_properties:
        reader = reader.option("mergeSchema", "true")
    stored = _stored(reader, path, class_name).where(F.col("outcome").isin(SENT, STORED) & F.col("id").isNotNull())
    # Objects stored on their way through a transport have an empty vector for none.
    stored = stored.withColumn("vector", F.when(F.size("vector") > 0, F.col("vector")))
    return stored.drop("outcome", "attempt", "error", REJECT)


def read_rejects(spark: SparkSession, path: str, class_name: str) -> DataFrame:
    """Records that batches of a class have set aside, with the reason."""
    stored = _stored(spark.read, path, class_name).where((F.col("outcome") == REJECTED) & F.col(REJECT).isNotNull())
    return stored.select("run", "batch_id", "topic", "partition", "offset", f"{REJECT}.*")


def read_failures(spark: SparkSession, path: str, class_name: str) -> DataFrame:
    """Objects that batches of a class could not send, with the attempts and the last error."""
    stored = _stored(spark.read, path, class_name).where((F.col("outcome") == FAILED) & F.col("id").isNotNull())
    return stored.drop("outcome", REJECT)


def write_order(stored: DataFrame) -> list[Column]:
    """By what the last object of an id is told: the write, then the record position where objects carry one."""
    order = [F.col("written_at"), F.col("batch_id")]
    return order + [F.col(name) for name in ("topic", "partition", "offset") if name in stored.columns]


def stored_batches(spark: SparkSession, path: str, class_name: str) -> DataFrame:
    """The batches of a class, `(run, batch_id, written_at)`; reads no more than the time of writing."""
    batch_folder(path, class_name, "any", 0)
    return _stored(spark.read, path, class_name).select("run", "batch_id", "written_at").distinct()


def read_collection(
    spark: SparkSession, path: str, class_name: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """One object per class and id: the last one written.

    Within one write the later record position wins, where objects carry one. Rows whose id
    occurs once stay where they are read; only those that may be repeated are shuffled whole.
    """
    stored = scan_collection(spark, path, class_name, schema)
    keys = ["class", "id"]
    repeated = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    told = with_maybe(stored, keys, key_filter(repeated, keys), "_maybe")
    once, more = told.where("NOT _maybe").drop("_maybe"), told.where("_maybe").drop("_maybe")
    return once.unionByName(keep_last(more, keys, write_order(more)))


def stored_ids(spark: SparkSession, path: str, class_name: str | None = None) -> DataFrame:
    """Class and id of every object, once; reads no other column and sorts nothing."""
    return scan_collection(spark, path, class_name, all_properties=False).select("class", "id").distinct()


def object_counts(spark: SparkSession, path: str) -> DataFrame:
    """Objects per class."""
    return stored_ids(spark, path).groupBy("class").agg(F.count(F.lit(1)).alias("objects"))


def batch_totals(spark: SparkSession, path: str, class_name: str, run: str) -> DataFrame:
    """Stored rows per micro-batch of a run, counted from what is stored.

    A replayed batch replaced its folder, so it is counted once, also after a
    restart of the driver.
    """
    stored = scan_collection(spark, path, class_name, all_properties=False).where(F.col("run") == run)
    return stored.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
