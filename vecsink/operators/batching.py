"""Row positions and batches within a key, without one task per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A bucket is 2**16 order values: what one window group sorts at most. A key
# with 10**11 records has some 1.5 million buckets, which is what the prefix
# sum over counts sees.
BUCKET_BITS = 16


def with_position(
    df: DataFrame, keys: Sequence[str], order: str, name: str, bucket_bits: int = BUCKET_BITS
) -> DataFrame:
    """Add the 0-based position of each row within its keys, by an integer column.

    `order` must be unique within the keys and reasonably dense, as record
    offsets and sequence numbers are. A key may hold any share of the rows: its
    rows are spread over buckets of the order column, each bucket is numbered by
    itself, and the rows before it are added from a small table of counts. The
    rows are shuffled once; the counts need only the keys and the order column.
    """
    # One struct column as the key: it is never null itself, so rows with null
    # keys join too, and join and window share one partitioning.
    slot = F.struct(*keys, F.shiftright(order, bucket_bits).alias("_bucket"))
    spread = df.withColumn("_slot", slot)
    counts = spread.groupBy("_slot").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = (
        Window.partitionBy(*[f"_slot.{key}" for key in keys])
        .orderBy("_slot._bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select("_slot", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_slot").orderBy(order)
    numbered = spread.join(starts, "_slot").withColumn(name, F.col("_before") + F.row_number().over(inside) - 1)
    return numbered.select(*df.columns, name)


def assign_batches(
    df: DataFrame,
    size: int,
    keys: Sequence[str] = ("topic", "partition"),
    offset: str = "offset",
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Add `batch_no`: every `size` rows of a topic partition, in offset order.

    Works on records as they come, before decoding, so that numbering reads no
    more than the three position columns.
    """
    if size < 1:
        raise ValueError("batch size must be at least 1")
    placed = with_position(df, keys, offset, "_position", bucket_bits)
    return placed.withColumn("batch_no", F.call_function("div", "_position", F.lit(size))).drop("_position")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row per keys under an order.

    Spark keeps the best row of each group before the shuffle as well, so a hot
    key sends at most one row per map task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[column.desc() for column in order])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
