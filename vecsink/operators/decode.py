"""Avro bodies of several schemas to one superset column, in a single pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecsink.functions import wire
from vecsink.functions.avro import Schemas, avro_to_spark, superset
from vecsink.functions.avro_body import OK, decode_bodies
from vecsink.operators.envelope import BAD_PAYLOAD, UNKNOWN_SCHEMA, UNSUPPORTED_SCHEMA


def _wanted(schemas: Schemas, fields: Sequence[str] | None) -> dict[str, str]:
    merged = superset(schemas)
    if fields is None:
        return merged
    missing = [name for name in fields if name not in merged]
    if missing:
        raise ValueError(f"no schema has the fields {missing}")
    return {name: merged[name] for name in fields}


def _raw_type(avro: str) -> str:
    # Text leaves the task as bytes and is made valid on the JVM side.
    return "binary" if avro in ("string", "bytes") else avro_to_spark(avro).simpleString()


def body_decoder(schemas: Schemas, fields: Sequence[str] | None = None):
    """Arrow UDF `(schema_id, payload) -> struct<fields..., OK>`.

    Only these two columns travel to the Python worker; the rest of the row
    waits in the JVM.
    """
    wanted = _wanted(schemas, fields)
    plain = dict(schemas)
    result = ", ".join([f"`{name}`: {_raw_type(avro)}" for name, avro in wanted.items()] + [f"`{OK}`: boolean"])

    @F.arrow_udf(f"struct<{result}>")
    def decode(ids: pa.Array, bodies: pa.Array) -> pa.Array:
        return decode_bodies(ids, bodies, plain, wanted)

    # A filter on the outcome must not be moved below the call, or bodies would
    # be decoded once for the filter and once more for the columns.
    return decode.asNondeterministic()


def _record(decoded: Column, wanted: Mapping[str, str]) -> Column:
    columns = []
    for name, avro in wanted.items():
        column = decoded.getField(name)
        columns.append((wire.text(column) if avro == "string" else column).alias(name))
    return F.struct(*columns)


def _schema_fault(schemas: Schemas) -> Column:
    """Why records of a schema id cannot be decoded, if so."""
    unsupported = sorted(schema_id for schema_id, fields in schemas.items() if fields is None)
    fault = F.when(~F.col("schema_id").isin(sorted(schemas)), UNKNOWN_SCHEMA) if schemas else F.lit(UNKNOWN_SCHEMA)
    return fault.when(F.col("schema_id").isin(unsupported), UNSUPPORTED_SCHEMA) if unsupported else fault


def decode_values(parsed: DataFrame, schemas: Schemas, fields: Sequence[str] | None = None) -> DataFrame:
    """Add `record`, a struct of the superset fields, and settle `reject_reason`.

    No shuffle and no join: schemas travel with the task. `fields` limits the
    output to what is used, which a Python step would otherwise hide from the
    optimizer.
    """
    wanted = _wanted(schemas, fields)
    reason = F.coalesce(F.col("reject_reason"), _schema_fault(schemas))
    ready = parsed.withColumn("reject_reason", reason)
    body = F.when(F.col("reject_reason").isNull(), F.col("payload"))
    decoded = ready.withColumn("_decoded", body_decoder(schemas, fields)(F.col("schema_id"), body))
    failed = F.col("reject_reason").isNull() & ~F.coalesce(F.col("_decoded").getField(OK), F.lit(False))
    return decoded.select(
        *[name for name in parsed.columns if name not in ("reject_reason", "payload")],
        F.when(failed, BAD_PAYLOAD).otherwise(F.col("reject_reason")).alias("reject_reason"),
        _record(F.col("_decoded"), wanted).alias("record"),
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where("reject_reason IS NULL")


def rejected(decoded: DataFrame) -> DataFrame:
    """The original records that were set aside, with the reason."""
    return decoded.where("reject_reason IS NOT NULL").select(
        "key", "value", "topic", "partition", "offset", "timestamp", "timestampType", "schema_id", "reject_reason"
    )


def strict(decoded: DataFrame) -> DataFrame:
    """Pass accepted records on; fail the job at the first reject."""
    where = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    failure = F.raise_error(F.concat(F.lit("rejected record "), where, F.lit(": "), F.col("reject_reason"), F.coalesce(F.concat(F.lit(" of schema id "), F.col("schema_id").cast("string")), F.lit(""))))
    return decoded.where(F.when(F.col("reject_reason").isNull(), True).otherwise(failure.cast("boolean")))
