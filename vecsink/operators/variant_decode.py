"""Avro bodies to records that describe themselves: one VARIANT column, whatever the schemas.

Each record keeps its own fields and their types. The plan does not depend on the schemas: they are looked
up where records are decoded, so a stream takes up new ones while it runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecsink.functions.avro import Field
from vecsink.functions.avro_body import OK, decode_bodies
from vecsink.functions.variant import ARROW, encode_objects
from vecsink.operators.enrich import METADATA
from vecsink.operators.envelope import BAD_PAYLOAD, UNKNOWN_SCHEMA, UNSUPPORTED_SCHEMA
from vecsink.sources.schema_lookup import lookup_of

# What a null of a type becomes in an object. A null of a type that is not named is left out.
DEFAULTS = {"string": b"", "boolean": False, "int": 0, "double": 0.0}
# Types that an object may hold.
HELD = ("string", "boolean", "int", "long", "double")

RESULT = T.StructType([T.StructField("reason", T.StringType()), T.StructField("record", T.VariantType())])


def object_fields(fields: tuple[Field, ...] | None) -> tuple[Field, ...] | None:
    """The fields, or None if an object cannot hold them all beside the record's metadata."""
    if fields is None or any(f.avro not in HELD or f.name in METADATA for f in fields):
        return None
    return fields


def _as_objects(columns: dict[str, tuple[str, pa.Array]], count: int) -> pa.StructArray:
    """Records under the rules for objects: nulls as defaults, or left out."""
    open_fields = []
    for name, (avro, column) in columns.items():
        if column.null_count and avro in DEFAULTS:
            columns[name] = (avro, column.fill_null(DEFAULTS[avro]))
        elif column.null_count:
            open_fields.append(name)
    if not open_fields:
        return encode_objects(columns, count)
    # Rows that lack the same fields are written together.
    absent = np.stack([columns[n][1].is_null().to_numpy(zero_copy_only=False) for n in open_fields], axis=1)
    kinds, kind = np.unique(absent, axis=0, return_inverse=True)
    parts, places = [], []
    for number, lacks in enumerate(kinds):
        rows = np.flatnonzero(kind.ravel() == number)
        gone = {n for n, lack in zip(open_fields, lacks, strict=True) if lack}
        chosen = {n: (avro, column.take(pa.array(rows))) for n, (avro, column) in columns.items() if n not in gone}
        parts.append(encode_objects(chosen, len(rows)))
        places.append(rows)
    return pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(places), kind="stable")))


def variants_of(ids: pa.Array, bodies: pa.Array, source, as_objects: bool) -> pa.StructArray:
    """Per row why it cannot be read (null: it can) and its record."""
    count = len(ids)
    reason = np.full(count, UNKNOWN_SCHEMA, dtype=object)
    row_ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    present = ids.is_valid().to_numpy(zero_copy_only=False)
    parts, places = [], []
    for schema_id, fields in lookup_of(ids, source).items():
        rows = np.flatnonzero(present & (row_ids == schema_id))
        fields = object_fields(fields) if as_objects else fields
        if fields is None:
            reason[rows] = UNSUPPORTED_SCHEMA
            continue
        at = pa.array(rows)
        wanted = {f.name: f.avro for f in fields}
        read = decode_bodies(ids.take(at), bodies.take(at), {schema_id: fields}, wanted)
        good = read.field(OK).to_numpy(zero_copy_only=False)
        reason[rows] = np.where(good, None, BAD_PAYLOAD)
        rows, kept = rows[good], pa.array(np.flatnonzero(good))
        columns = {n: (avro, read.field(n).take(kept)) for n, avro in wanted.items()}
        parts.append(_as_objects(columns, len(rows)) if as_objects else encode_objects(columns, len(rows)))
        places.append(rows)
    where = np.full(count, -1, dtype=np.int64)
    if places:
        where[np.concatenate(places)] = np.arange(sum(map(len, places)))
    every = pa.concat_arrays(parts) if parts else pa.array([], ARROW)
    records = every.take(pa.array(where, mask=where < 0))
    # A struct child that may not be null holds something in rows that are null as a whole.
    filled = [records.field(n).fill_null(b"") for n in ("value", "metadata")]
    records = pa.StructArray.from_arrays(filled, fields=list(ARROW), mask=pa.array(where < 0))
    return pa.StructArray.from_arrays([pa.array(reason, pa.string()), records], names=["reason", "record"])


def decode_variants(parsed: DataFrame, source, as_objects: bool = False) -> DataFrame:
    """Add `record`, a VARIANT, and settle `reject_reason`.

    source finds a schema by id (SchemaFolder, SchemaTexts). With as_objects the records are under the rules for
    objects: defaults for nulls, and no record of a schema with types that an object cannot hold.
    Rows that are rejects already are not decoded.
    """

    @F.arrow_udf(RESULT)
    def decode(ids: pa.Array, bodies: pa.Array) -> pa.Array:
        return variants_of(ids, bodies, source, as_objects)

    readable = F.col("reject_reason").isNull()
    called = decode.asNondeterministic()(F.when(readable, F.col("schema_id")), F.when(readable, F.col("payload")))
    decoded = parsed.withColumn("_decoded", called)
    return decoded.select(
        *[name for name in parsed.columns if name not in ("reject_reason", "payload")],
        F.coalesce("reject_reason", F.col("_decoded.reason")).alias("reject_reason"),
        F.col("_decoded.record").alias("record"),
    )
