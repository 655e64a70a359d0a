"""From Kafka-shaped rows to sent objects when each record keeps its own types.

The plan is the same whatever the schemas are; it serves tables and streams, and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from vecsink.functions import ids
from vecsink.functions.convert import convert_column
from vecsink.operators import decode, envelope
from vecsink.operators.enrich import METADATA
from vecsink.operators.variant_decode import decode_variants
from vecsink.plans.options import SinkOptions


def _joined(left: Column, right: Column) -> Column:
    """Two JSON objects as one; their names differ."""
    inner = F.substring(left, F.lit(2), F.char_length(left) - 2)
    return F.concat(F.lit("{"), inner, F.when(inner == "", "").otherwise(","), F.substring(right, 2, 2**31 - 1))


def _metadata(rows: DataFrame, name: str, source: str) -> Column:
    """A metadata value under the rules for objects."""
    return convert_column(StructField(name, rows.schema[source].dataType), value=F.col(source))


@dataclass(frozen=True)
class VariantPlan:
    """Decoded records and the objects made from them, all lazy."""

    decoded: DataFrame
    options: SinkOptions

    def objects(self, strict: bool = False) -> DataFrame:
        """Objects in sent form: class, id, vector (empty), properties as JSON text, and the record's position."""
        rows = decode.strict(self.decoded) if strict else decode.accepted(self.decoded)
        return rows.select(*self._made(rows))

    def outcomes(self) -> DataFrame:
        """All records in one pass: objects, and for a reject the record and why it is one."""
        rows = self.decoded.withColumn(envelope.REJECT, envelope.reject_record())
        return rows.select(*self._made(rows, F.col(envelope.REJECT).isNull()), envelope.REJECT)

    def _made(self, rows: DataFrame, ready: Column | None = None) -> list[Column]:
        def made(value: Column) -> Column:
            return value if ready is None else F.when(ready, value)

        metadata = F.to_json(F.struct(*[_metadata(rows, name, source).alias(name) for name, source in METADATA.items()]))
        no_id = F.raise_error(F.lit(f"a row for class {self.options.class_name} has no id")).cast("string")
        return [
            F.lit(self.options.class_name).alias("class"),
            made(F.coalesce(object_id(self.options), no_id)).alias("id"),
            F.array().cast("array<float>").alias("vector"),
            made(_joined(F.to_json("record"), metadata)).alias("properties"),
            *[F.col(name) for name in ("topic", "partition", "offset")],
        ]

    def rejects(self) -> DataFrame:
        return decode.rejected(self.decoded)


def object_id(options: SinkOptions) -> Column:
    """The id of a record: a field of its own, or its position."""
    if options.id is not None:
        source = METADATA.get(options.id)
        return F.col(source).cast("string") if source else F.try_variant_get("record", f"$.{options.id}", "string")
    return ids.random_id() if options.id_mode == "random" else ids.position_id(F.col("topic"), F.col("partition"), F.col("offset"))


def plan_variant_objects(kafka: DataFrame, source, options: SinkOptions) -> VariantPlan:
    """Parse, decode by schemas that are looked up, and settle rejects; records without an id are rejects too.

    Option `id` names a field as the schema spells it. Records are flat, so there is no vector.
    """
    if options.vector is not None:
        raise ValueError("records that keep their own types have no vector column")
    decoded = decode_variants(envelope.parse_envelope(kafka), source, as_objects=True)
    if options.id is not None:
        missing = object_id(options).isNull()
    else:
        missing = F.col("topic").isNull() | F.col("partition").isNull() | F.col("offset").isNull()
    if options.id is not None or options.id_mode == "position":
        reason = F.coalesce(F.col("reject_reason"), F.when(missing, envelope.NULL_ID))
        decoded = decoded.withColumn("reject_reason", reason)
    return VariantPlan(decoded, options)
