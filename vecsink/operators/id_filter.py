"""A Bloom filter of fixed size as a table: which rows surely have none of some keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a filter: at most 131,072 rows of 64 bits, whatever the data.
FILTER_BITS = 1 << 23
_PLACE, _SLOT, _BITS = "_filter_place", "_filter_slot", "_filter_bits"


def _place(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def key_filter(frame: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """The filter of a frame's keys."""
    bit = F.expr(f"shiftleft(1L, cast({_PLACE} % 64 as int))")
    placed = frame.select(_place(keys, bits).alias(_PLACE))
    return placed.groupBy((F.col(_PLACE) / 64).cast("int").alias(_SLOT)).agg(F.bit_or(bit).alias(_BITS))


def with_maybe(frame: DataFrame, keys: Sequence[str], kept: DataFrame, name: str = "maybe", bits: int = FILTER_BITS) -> DataFrame:
    """Add a boolean: false for rows whose key is surely not in the filter. Nothing is shuffled."""
    placed = frame.withColumn(_PLACE, _place(keys, bits)).withColumn(_SLOT, (F.col(_PLACE) / 64).cast("int"))
    maybe = F.expr(f"coalesce(shiftright({_BITS}, cast({_PLACE} % 64 as int)) & 1L, 0L) = 1L")
    return placed.join(F.broadcast(kept), _SLOT, "left").withColumn(name, maybe).drop(_PLACE, _SLOT, _BITS)
