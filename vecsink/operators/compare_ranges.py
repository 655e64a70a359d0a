"""Where two sets of records differ, found by fingerprints of offset ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecsink.operators.offsets import TOPIC_PARTITION, merge_spans
from vecsink.sources.scratch import scratch_folder

# Each level looks into the ranges that differ one level above: some 16 million offsets, then 16 thousand, then single ones.
LEVEL_BITS = (24, 14, 0)
_LOW = (1 << 32) - 1


def _prints() -> list[Column]:
    """An order-free fingerprint of rows: their number, and sums of the halves of two hashes, which copies do not cancel.

    The sums are of 32-bit numbers, so they hold for two thousand million rows of one range.
    """
    halves = [F.sum(part) for name in ("_h1", "_h2") for part in (F.col(name).bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(name, 32))]
    return [F.count(F.lit(1)).alias("_n"), *[half.alias(f"_s{i}") for i, half in enumerate(halves)]]


def _hashed(rows: DataFrame, keys: Sequence[str], offset: str, values: Sequence[str]) -> DataFrame:
    # Whether a value is there is hashed too: the hash of Spark passes over nulls.
    there = [F.col(name).isNull() for name in values]
    hashes = {"_h1": F.xxhash64(*values, *there), "_h2": F.xxhash64(F.lit(1), *reversed(there), *values)}
    return rows.select(*keys, F.col(offset).cast("bigint").alias("_offset"), *[column.alias(name) for name, column in hashes.items()])


def _both(source: DataFrame, stored: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """Fingerprints of both sides by range, those that differ.

    One aggregate over the union of both sides: rows meet as fingerprints, which Spark puts together before the shuffle.
    """
    slot = F.struct(*keys, F.shiftright("_offset", bits).alias("_range")).alias("_slot")
    sides = [side.select(slot, "_h1", "_h2", F.lit(name).alias("_side")) for name, side in (("a", source), ("b", stored))]
    prints = sides[0].unionByName(sides[1]).groupBy("_slot", "_side").agg(*_prints())
    shape = F.struct("_n", *[f"_s{i}" for i in range(4)])
    a, b = (F.max(F.when(F.col("_side") == side, shape)).alias(side) for side in ("a", "b"))
    return prints.groupBy("_slot").agg(a, b).where("NOT (a <=> b)")


def differing_ranges(
    source: DataFrame,
    stored: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = TOPIC_PARTITION,
    offset: str = "offset",
    level_bits: Sequence[int] = LEVEL_BITS,
    folder: str | None = None,
) -> DataFrame:
    """Where two tables differ: `(keys, fault, first_offset, last_offset)`, neighbours of one fault as one range.

    Faults of an offset, the first that holds: `missing` (not stored), `extra` (stored only), `doubled` (stored more
    often), `lost_copy` (stored less often), `changed` (as often, with other `values`). Rows of an offset are a bag: their order
    says nothing, and copies count. Nulls of keys and values are values; a row without an offset has offset null and
    is compared with the others of that kind.

    Each level reads both sides with `keys`, `offset` and `values` only, and shuffles fingerprints of ranges; below the first level
    only rows of ranges that differ go on. The ranges that differ are stored in between.
    """
    if not level_bits or level_bits[-1] != 0 or list(level_bits) != sorted(set(level_bits), reverse=True):
        raise ValueError("levels go down to single offsets")
    spark = source.sparkSession
    base = folder or scratch_folder(spark, "ranges")
    sides = [_hashed(side, keys, offset, values) for side in (source, stored)]
    above = None
    for bits in level_bits:
        if above is not None:
            wider, ranges = above
            inside = F.struct(*keys, F.shiftright("_offset", wider).alias("_range"))
            # A struct is never null itself, so rows with null keys and offsets join.
            narrowed = [side.withColumn("_slot", inside).join(ranges, "_slot", "left_semi").drop("_slot") for side in sides]
        else:
            narrowed = sides
        path = f"{base}/level={bits}"
        _both(*narrowed, keys, bits).write.parquet(path)
        above = (bits, spark.read.parquet(path).select("_slot"))
    found = spark.read.parquet(path)
    fault = (
        F.when(F.col("b").isNull(), "missing")
        .when(F.col("a").isNull(), "extra")
        .when(F.col("b._n") > F.col("a._n"), "doubled")
        .when(F.col("b._n") < F.col("a._n"), "lost_copy")
        .otherwise("changed")
    )
    single = found.select("_slot.*", fault.alias("fault"))
    spans = single.select(*keys, "fault", F.col("_range").alias("first_offset"), F.col("_range").alias("last_offset"))
    return merge_spans(spans, [*keys, "fault"])
