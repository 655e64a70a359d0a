"""Decoded fields followed by the record's Kafka metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.functions.avro import SchemaConflictError

# Metadata column names in output order, and where each comes from.
METADATA = {
    "_kafka_key": "key_text",
    "_kafka_topic": "topic",
    "_kafka_partition": "partition",
    "_kafka_offset": "offset",
    "_kafka_timestamp": "event_time",
    "_kafka_timestampType": "timestampType",
    "_kafka_schemaId": "schema_id",
}


def enrich(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`record.*`, the seven metadata columns and the columns named by `keep`."""
    reserved = {name.lower() for name in (*METADATA, *keep)}
    taken = [f.name for f in decoded.schema["record"].dataType.fields if f.name.lower() in reserved]
    if taken:
        raise SchemaConflictError(f"fields {taken} have the names of added columns")
    metadata = [F.col(source).alias(name) for name, source in METADATA.items()]
    return decoded.select("record.*", *metadata, *keep)
