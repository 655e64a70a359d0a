"""Rows to objects: a class, an id, an optional vector and properties."""

from __future__ import annotations

from collections.abc import Mapping, Sequence, Set

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecsink.functions import ids
from vecsink.functions.convert import as_vector, check_vector, convert_column, validate_types
from vecsink.operators.enrich import METADATA

#: In a column's metadata: the field that it was made for, if that has another name.
FIELD = "field"
_POSITION = ("_kafka_topic", "_kafka_partition", "_kafka_offset")


def find_column(df: DataFrame, name: str, role: str) -> str:
    """The column an option names, in any letter case."""
    for column in df.columns:
        if column.lower() == name.lower():
            return column
    raise ValueError(f"{role} column {name!r} is not in the frame: {df.columns}")


def object_id(df: DataFrame, id_column: str | None = None, id_mode: str = "position") -> Column:
    if id_column is not None:
        return F.col(f"`{find_column(df, id_column, 'id')}`").cast("string")
    if id_mode == "random":
        return ids.random_id()
    if id_mode != "position":
        raise ValueError(f"idMode must be position or random, not {id_mode!r}")
    missing = [name for name in _POSITION if name not in df.columns]
    if missing:
        raise ValueError(f"ids from positions need the columns {missing}; name an id column or set idMode to random")
    return ids.position_id(*[F.col(name) for name in _POSITION])


def to_objects(
    df: DataFrame,
    class_name: str,
    id_column: str | None = None,
    vector_column: str | None = None,
    id_mode: str = "position",
    presence: Mapping[str, Set[int]] | None = None,
    written: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
    ready: Column | None = None,
) -> DataFrame:
    """`class, id, vector, properties` by one projection over any frame.

    A frame with record positions has them as `topic, partition, offset` beside the
    properties, so that the last object of an id is known in any stored form.

    `presence` maps a field to the schema ids that have it; rows of other
    schemas keep a null there, which the wire form leaves out. `written` maps a column to the
    field that it was made for, where several types of one field have a column each.
    Columns in `keep` go along beside the object; rows that are not `ready` have no id and no properties.
    """
    id_name = find_column(df, id_column, "id") if id_column is not None else None
    vector_name = find_column(df, vector_column, "vector") if vector_column is not None else None
    if vector_name is not None and vector_name == id_name:
        raise ValueError("id and vector are the same column")
    rest = [f for f in df.schema.fields if f.name not in (id_name, vector_name, *keep)]
    if not rest:
        raise ValueError("no column is left for properties")
    validate_types(type(df.schema)(rest))
    if vector_name is not None:
        check_vector(df.schema[vector_name])

    everywhere = set().union(*presence.values()) if presence else set()
    properties = []
    for field in rest:
        held = (presence or {}).get(field.name)
        partial = field.name not in METADATA and held is not None and set(held) != everywhere
        present = F.col("_kafka_schemaId").isin(sorted(held)) if partial else None
        own = {FIELD: written[field.name]} if written and field.name in written else {}
        properties.append(convert_column(field, present).alias(field.name, metadata=own))
    vector = as_vector(F.col(f"`{vector_name}`")) if vector_name else F.lit(None).cast("array<float>")
    # A row without an id would be lost among others without one.
    no_id = F.raise_error(F.lit(f"a row for class {class_name} has no id")).cast("string")
    held = all(name in df.columns for name in _POSITION)
    position = [F.col(name).alias(name.removeprefix("_kafka_")) for name in _POSITION] if held else []

    def made(value: Column) -> Column:
        return value if ready is None else F.when(ready, value)

    return df.select(
        F.lit(class_name).alias("class"),
        made(F.coalesce(object_id(df, id_column, id_mode), no_id)).alias("id"),
        made(vector).alias("vector"),
        made(F.struct(*properties)).alias("properties"),
        *position,
        *keep,
    )


def to_wire(objects: DataFrame) -> DataFrame:
    """Properties as JSON text, without the absent fields, and no null vectors.

    A missing vector travels as an empty one: Spark's writer of Arrow batches
    goes over all earlier rows again for each null array.
    """
    wired = objects.withColumn("vector", F.coalesce("vector", F.array().cast("array<float>")))
    if objects.schema["properties"].dataType.typeName() == "string":
        return wired
    # Columns for clashing types of one field are written under its one name; all but one are absent.
    fields = objects.schema["properties"].dataType.fields
    named = F.struct(*[F.col("properties").getField(f.name).alias(f.metadata.get(FIELD, f.name)) for f in fields])
    return wired.withColumn("properties", F.to_json(named, {"ignoreNullFields": "true"}))
