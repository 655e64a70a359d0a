"""Cutting lineage in the shared folder, and splitting column batches into bounded slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecsink.operators.id_filter import FILTER_BITS, key_filter
from vecsink.operators.id_filter import with_maybe as maybe_in

#: Bytes of text that a task works on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only in local mode, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    set_before = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_before.isDefined():
        return set_before.get()
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written as Parquet to the shared folder and read again.

    What is read again is the same for each reader and survives lost executors.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """Strings with 64-bit offsets; null is empty."""
    return batch.column(name).cast(pa.large_string()).fill_null("")


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many bytes of text, or one row. Memory of a batch that is done goes back to the system."""
    import numpy as np

    count = len(texts)
    if count == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + count + 1]
    start = 0
    while start < count:
        stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        stop = min(count, max(stop, start + 1))
        yield start, stop
        start = stop
    pa.default_memory_pool().release_unused()


def crc_bucket(column: str, buckets: int):
    """crc32 of an id written as text, modulo buckets."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % buckets


def id_filter(frame: DataFrame, column: str, bits: int = FILTER_BITS) -> tuple[DataFrame, int]:
    """A Bloom filter over the ids, of so many bits at most."""
    return key_filter(frame, [column], bits), bits


def with_maybe(frame: DataFrame, column: str, kept: tuple[DataFrame, int]) -> DataFrame:
    """The frame with the column maybe: false for rows whose id is surely not in the filter."""
    return maybe_in(frame, [column], kept[0], bits=kept[1])


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys as one table, across batches; what is held is one run."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for values in columns:
            new[1:] |= values[1:] != values[:-1]
        new[0] = last is not None and any(v[0] != x for v, x in zip(columns, last, strict=True))
        cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        if cuts[0] > 0:
            held.append(batch.slice(0, cuts[0]))
        for begin, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(begin, stop - begin)]
        last = [v[-1] for v in columns]
    if held:
        yield pa.Table.from_batches(held)


def without(frame: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """Rows of which the id is not in gone (distinct ids); only rows that may be are shuffled. Null ids stay."""
    told = with_maybe(frame, column, id_filter(gone, column))
    rest = told.where("maybe").drop("maybe").join(gone, column, "left_anti")
    return told.where("not maybe").drop("maybe").unionByName(rest)
