"""The whole plan from Kafka-shaped rows to objects.

The same code builds the batch and the streaming plan: every step is a
projection or a filter, so nothing is shuffled and nothing keeps state.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.functions.avro import Schemas, presence, settle_conflicts, written_names
from vecsink.operators import decode, enrich, envelope, objects
from vecsink.plans.options import SinkOptions


@dataclass(frozen=True)
class ObjectPlan:
    """Decoded records and what follows from them, all lazy."""

    decoded: DataFrame
    schemas: Schemas
    options: SinkOptions

    def rows(self, strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
        """Accepted rows with metadata columns and further columns of the records."""
        settled = decode.strict(self.decoded) if strict else decode.accepted(self.decoded)
        return enrich.enrich(settled, keep)

    def objects(self, strict: bool = False) -> DataFrame:
        return objects.to_objects(
            self.rows(strict),
            self.options.class_name,
            self.options.id,
            self.options.vector,
            self.options.id_mode,
            presence(self.schemas),
            written_names(self.schemas),
        )

    def outcomes(self) -> DataFrame:
        """All records in one pass: objects, and for a reject the record and why it is one."""
        told = self.decoded.withColumn(envelope.REJECT, envelope.reject_record())
        return objects.to_objects(
            enrich.enrich(told, [envelope.REJECT]),
            self.options.class_name,
            self.options.id,
            self.options.vector,
            self.options.id_mode,
            presence(self.schemas),
            written_names(self.schemas),
            keep=[envelope.REJECT],
            ready=F.col(envelope.REJECT).isNull(),
        )

    def rejects(self) -> DataFrame:
        return decode.rejected(self.decoded)


def plan_objects(
    kafka: DataFrame,
    schemas: Schemas,
    options: SinkOptions,
    fields: Sequence[str] | None = None,
) -> ObjectPlan:
    """Parse, decode and settle rejects; records without an id are rejects too.

    Fields of one name with types that do not fit one column get a column for each type; the
    wire form writes them under their one name. Options `id` and `vector` name the first one.
    """
    schemas = settle_conflicts(schemas)
    decoded = decode.decode_values(envelope.parse_envelope(kafka), schemas, fields)
    if options.id is not None:
        column = objects.find_column(enrich.enrich(decoded), options.id, "id")
        source = enrich.METADATA.get(column)
        value = F.col("record").getField(column) if source is None else F.col(source)
        missing = value.isNull()
    else:
        missing = F.col("topic").isNull() | F.col("partition").isNull() | F.col("offset").isNull()
    if options.id is not None or options.id_mode == "position":
        reason = F.coalesce(F.col("reject_reason"), F.when(missing, envelope.NULL_ID))
        decoded = decoded.withColumn("reject_reason", reason)
    return ObjectPlan(decoded, schemas, options)
