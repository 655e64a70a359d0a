"""Compaction of a collection: the last object per id, sorted, and which batches that covers.

`<path>/_snapshots/class=<class>/objects/version=<n>` holds the objects and `.../covers/version=<n>` the batches, written
after them, so a version without covers does not count. Readers of the collection itself do not see the folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecsink.operators.batching import keep_last
from vecsink.operators.id_filter import key_filter, with_maybe
from vecsink.sources.collection import batch_folder, scan_collection, stored_batches, write_order
from vecsink.sources.scratch import scratch_folder

# What tells a batch from another and from an earlier writing of it.
BATCH = ("run", "batch_id", "written_at")


def _root(path: str, class_name: str) -> str:
    batch_folder(path, class_name, "any", 0)
    return f"{path.rstrip('/')}/_snapshots/class={class_name}"


def _covers(spark: SparkSession, path: str, class_name: str) -> DataFrame:
    """The batches of every version, `(version, run, batch_id, written_at)`."""
    try:
        stored = spark.read.parquet(f"{_root(path, class_name)}/covers")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "version bigint, run string, batch_id bigint, written_at timestamp")
    return stored.select(F.col("version").cast("bigint").alias("version"), *BATCH)


def latest_version(spark: SparkSession, path: str, class_name: str) -> int | None:
    """The newest version whose batches are all as they were.

    A batch that was written again since has other objects, and what a version left out in favour of the
    earlier ones is only in the collection; so versions that cover it are passed over.
    """
    return _newest_whole(_covers(spark, path, class_name), stored_batches(spark, path, class_name))


def _newest_whole(covers: DataFrame, batches: DataFrame) -> int | None:
    told = covers.join(batches.withColumn("_there", F.lit(True)), list(BATCH), "left")
    whole = told.groupBy("version").agg(F.bool_and(F.col("_there").isNotNull()).alias("whole")).where("whole")
    return whole.agg(F.max("version").alias("version")).first()["version"]


def _newer(spark: SparkSession, path: str, class_name: str, batches: DataFrame, version: int | None) -> DataFrame:
    if version is None:
        return batches
    return batches.join(_covers(spark, path, class_name).where(F.col("version") == version), list(BATCH), "left_anti")


def _merged(spark: SparkSession, path: str, class_name: str, batches: DataFrame, version: int | None) -> DataFrame:
    """Objects of a version and of the newer batches, the last one per id."""
    stored = scan_collection(spark, path, class_name).join(_newer(spark, path, class_name, batches, version), list(BATCH), "left_semi")
    if version is None:
        return keep_last(stored, ["id"], write_order(stored))
    # Only objects whose id may be in a newer batch meet them; the others stay where they are read.
    whole = spark.read.option("mergeSchema", "false").parquet(f"{_root(path, class_name)}/objects/version={version}")
    told = with_maybe(whole, ["id"], key_filter(stored, ["id"]), "_maybe")
    once, met = told.where("NOT _maybe").drop("_maybe"), told.where("_maybe").drop("_maybe")
    both = met.unionByName(stored, allowMissingColumns=True)
    return once.unionByName(keep_last(both, ["id"], write_order(both)), allowMissingColumns=True)


def compact(spark: SparkSession, path: str, class_name: str) -> int | None:
    """Merge the newest version with the batches since; the number of the new version, or null if there is nothing newer.

    One compaction of a class at a time; batches may land meanwhile, and are newer than the version then. Objects are
    dealt to ranges of ids and sorted by id, so that a filter on ids reads few row groups. Batches and earlier
    versions stay: what may be removed, and when, is for the owner of the folder.
    """
    # What is covered is fixed before any object is read.
    listed = scratch_folder(spark, "batches")
    stored_batches(spark, path, class_name).write.parquet(listed)
    batches = spark.read.parquet(listed)
    covers = _covers(spark, path, class_name)
    version = _newest_whole(covers, batches)
    if version is not None and _newer(spark, path, class_name, batches, version).isEmpty():
        return None
    number = (covers.agg(F.max("version").alias("version")).first()["version"] or 0) + 1
    merged = _merged(spark, path, class_name, batches, version).repartitionByRange("id").sortWithinPartitions("id")
    merged.write.mode("overwrite").parquet(f"{_root(path, class_name)}/objects/version={number}")
    batches.select(*BATCH).write.parquet(f"{_root(path, class_name)}/covers/version={number}")
    return number


def read_compacted(spark: SparkSession, path: str, class_name: str) -> DataFrame:
    """One object per id, the last one written: the newest version and the batches since.

    The same rows as `read_collection`. Of batches that the version covers only the column is read that tells when they were written.
    """
    batches = stored_batches(spark, path, class_name)
    version = latest_version(spark, path, class_name)
    return _merged(spark, path, class_name, batches, version)
