"""Offsets of topic partitions: what is missing, what belongs together, where a time starts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecsink.sources.scratch import scratch_folder

TOPIC_PARTITION = ("topic", "partition")
# A bucket is 2**15 offsets, which is what a bitmap of Spark holds; 2**15 buckets meet before those of a key do.
BUCKET_BITS = 15
SPAN_BITS = 2 * BUCKET_BITS


class DataLossError(ValueError):
    """Records are missing and the reader wants to fail."""


def _slot(keys: Sequence[str], offset: str, bits: int | None) -> Column:
    """A struct of the keys and a range of offsets; without `bits`, of the keys alone."""
    return F.struct(*keys, *([] if bits is None else [F.shiftright(offset, bits).alias("_range")]))


def merge_spans(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spans `(keys, first_offset, last_offset)` that touch or overlap, as one span each.

    They are merged within buckets of offsets, then within ranges of buckets, then within keys, so that no task
    sorts more than the offsets of a bucket or what is left of many.
    """
    merged = spans.select(*keys, "first_offset", "last_offset")
    for bits in (BUCKET_BITS, SPAN_BITS, None):
        slotted = merged.withColumn("_slot", _slot(keys, "first_offset", bits))
        ordered = Window.partitionBy("_slot").orderBy("first_offset", "last_offset")
        reach = F.max("last_offset").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
        opens = slotted.withColumn("_opens", F.coalesce((F.col("first_offset") > reach + 1).cast("int"), F.lit(1)))
        group = F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ends = opens.withColumn("_group", group).groupBy("_slot", "_group")
        merged = ends.agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        merged = merged.select(*[F.col(f"_slot.{key}").alias(key) for key in keys], "first_offset", "last_offset")
    return merged


def _between(buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gaps between spans `(keys, first_offset, last_offset)` that do not overlap."""
    found, ends = None, buckets.select(*keys, "first_offset", "last_offset")
    for bits in (SPAN_BITS, None):
        slotted = ends.withColumn("_slot", _slot(keys, "first_offset", bits))
        ordered = Window.partitionBy("_slot").orderBy("first_offset")
        gaps = slotted.withColumn("_left", F.lag("last_offset").over(ordered)).where("first_offset > _left + 1")
        gaps = gaps.select(*keys, (F.col("_left") + 1).alias("first_offset"), (F.col("first_offset") - 1).alias("last_offset"))
        found = gaps if found is None else found.unionByName(gaps)
        ends = slotted.groupBy("_slot").agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        ends = ends.select(*[F.col(f"_slot.{key}").alias(key) for key in keys], "first_offset", "last_offset")
    return found


def offset_gaps(
    records: DataFrame,
    expected: DataFrame | None = None,
    keys: Sequence[str] = TOPIC_PARTITION,
    offset: str = "offset",
    folder: str | None = None,
) -> DataFrame:
    """Every gap of the offsets of a topic partition: `(keys, first_offset, last_offset, missing)`.

    Offsets become one bitmap per bucket before they are shuffled, so a partition of any size is many small groups, and
    records that occur twice count once. Missing offsets are read off the bitmaps; gaps that hold whole buckets come from
    the ends of neighbours. `expected` names the offsets that there should be, as `(keys, start, end)` with `end` excluded;
    then what is missing at the ends is a gap too, and a partition without any record is one gap. Rows without an
    offset are passed over; null keys are keys of their own.
    """
    spark = records.sparkSession
    present = records.where(F.col(offset).isNotNull()).select(*keys, F.col(offset).cast("bigint").alias("_offset"))
    if expected is not None:
        # The neighbours of what is expected count as present, so its ends need no rule of their own.
        wanted = expected.where(F.col("end") > F.col("start"))
        present = present.unionByName(wanted.select(*keys, F.explode(F.array(F.col("start").cast("bigint") - 1, F.col("end").cast("bigint"))).alias("_offset")))
    slotted = present.select(_slot(keys, "_offset", BUCKET_BITS).alias("_slot"), "_offset")
    bit = F.pmod("_offset", F.lit(1 << BUCKET_BITS))
    buckets = slotted.groupBy("_slot").agg(
        F.min("_offset").alias("first_offset"),
        F.max("_offset").alias("last_offset"),
        F.bitmap_construct_agg(bit).alias("_bits"),
    )
    holed = F.bitmap_count("_bits") < F.col("last_offset") - F.col("first_offset") + 1
    path = folder or scratch_folder(spark, "buckets")
    stored = buckets.select("_slot.*", "first_offset", "last_offset", F.when(holed, F.col("_bits")).alias("_bits"))
    stored.write.parquet(path)
    stored = spark.read.parquet(path)
    # Where a byte has a bit for an offset, counted from its lowest.
    place = F.pmod("_at", F.lit(1 << BUCKET_BITS))
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast(pmod(_at, {1 << BUCKET_BITS}) div 8 + 1 as int), 1)")), 16, 10).cast("int")
    unset = F.expr("(_byte >> cast(_place % 8 as int)) & 1 = 0")
    offsets = stored.where("_bits IS NOT NULL").withColumn("_at", F.explode(F.sequence("first_offset", "last_offset")))
    missing = offsets.withColumns({"_byte": byte, "_place": place}).where(unset)
    inside = merge_spans(missing.select(*keys, F.col("_at").alias("first_offset"), F.col("_at").alias("last_offset")), keys)
    gaps = inside.unionByName(_between(stored, keys))
    return gaps.withColumn("missing", F.col("last_offset") - F.col("first_offset") + 1)


def refuse_loss(records: DataFrame, expected: DataFrame | None = None, keys: Sequence[str] = TOPIC_PARTITION) -> None:
    """Fail if offsets are missing, naming how many and the largest gap."""
    gaps = offset_gaps(records, expected, keys)
    worst = F.max_by(F.struct(*keys, "first_offset", "last_offset"), "missing").alias("worst")
    told = gaps.agg(F.count(F.lit(1)).alias("gaps"), F.sum("missing").alias("missing"), worst).first()
    if told["gaps"]:
        raise DataLossError(f"{told['missing']} offsets are missing in {told['gaps']} gaps, the largest {told['worst'].asDict()}")


def start_at(records: DataFrame, since: Column, keys: Sequence[str] = TOPIC_PARTITION) -> DataFrame:
    """Records from the first offset of each partition whose time is not before `since`.

    As a topic is read from a time on: later offsets are read whatever their time is, and a partition
    without such a record gives none.
    """
    starts = records.where(F.col("timestamp") >= since).groupBy(*keys).agg(F.min("offset").alias("_start"))
    same = [records[key].eqNullSafe(starts[key]) for key in keys]
    return records.join(starts, [*same, records["offset"] >= starts["_start"]], "left_semi")
