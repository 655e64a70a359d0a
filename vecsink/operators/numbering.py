"""Row positions by a sparse order: ids made of a time and a counter, timestamps, texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecsink.sources.scratch import scratch_folder

# Spark's own ids of rows: the number of the partition above 33 bits, the place in it below.
_PLACE_BITS = 33


def with_sparse_position(
    df: DataFrame, keys: Sequence[str], order: str, name: str, ranges: int | None = None, folder: str | None = None
) -> DataFrame:
    """Add the 0-based position of each row within its keys, by a column of any type that sorts.

    Rows are dealt to ranges of (keys, order), whose bounds Spark samples, so a key may hold any share of the rows
    and its values may lie as far apart as they like. Each range is sorted and stored once with the places of its
    rows; what lies before a range is a prefix sum over one count per range and key. Rows are shuffled once.

    Null keys are a key of their own and null order values come first. Rows that agree in keys and order get different
    positions in no particular order, and share one range. `ranges` is Spark's number of shuffle partitions
    unless given; the stored table goes to `folder`, or to a new one beside the other intermediate tables.
    """
    if ranges is not None and ranges < 1:
        raise ValueError("there must be at least one range")
    spark = df.sparkSession
    path = folder or scratch_folder(spark, "numbered")
    by = [*keys, order]
    dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    dealt.sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    # The key is a struct, which is never null itself, so that rows with null keys join too.
    slot = F.struct(*keys, F.shiftright("_row", _PLACE_BITS).alias("_range"))
    stored = spark.read.parquet(path).withColumn("_slot", slot)
    counts = stored.groupBy("_slot").agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*[f"_slot.{key}" for key in keys]).orderBy("_slot._range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_slot", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = stored.join(starts, "_slot").withColumn(name, F.col("_before") + F.col("_row") - F.col("_first"))
    return placed.select(*df.columns, name)


def assign_sparse_batches(
    df: DataFrame, size: int, keys: Sequence[str], order: str, ranges: int | None = None, folder: str | None = None
) -> DataFrame:
    """Add `batch_no`: every `size` rows of a key, by a sparse order."""
    if size < 1:
        raise ValueError("batch size must be at least 1")
    placed = with_sparse_position(df, keys, order, "_position", ranges, folder)
    return placed.withColumn("batch_no", F.call_function("div", "_position", F.lit(size))).drop("_position")
