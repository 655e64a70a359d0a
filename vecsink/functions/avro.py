"""Avro record schemas as Spark types, worked out on the driver."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import types as T

# The Avro primitives a record may use and the Spark type of each.
AVRO_TO_SPARK = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}

# Which pairs of types may share one column, and the type that holds both.
# No other pair: a long beyond 2**53 is not a double, and whole numbers are not written as fractions.
_WIDER = {frozenset({"int", "long"}): "long"}


class UnsupportedTypeError(ValueError):
    """A type that cannot be decoded or cannot be stored in an object."""


class SchemaConflictError(ValueError):
    """Schemas that cannot be read into one table."""


class Field(NamedTuple):
    """One record field. `null_branch` is the index of null in its union.

    `written` is the field's own name where its column has another.
    """

    name: str
    avro: str
    null_branch: int | None = None
    written: str | None = None


# Parsed fields per schema id; None for a schema with types that are not read.
Schemas = Mapping[int, "tuple[Field, ...] | None"]


def readable(schemas: Schemas) -> dict[int, tuple[Field, ...]]:
    return {schema_id: fields for schema_id, fields in schemas.items() if fields is not None}


def avro_to_spark(avro: str) -> T.DataType:
    if avro not in AVRO_TO_SPARK:
        raise UnsupportedTypeError(f"Avro type {avro!r} cannot be decoded")
    return AVRO_TO_SPARK[avro]


def _field(name: str, declared) -> Field:
    null_branch = None
    if isinstance(declared, list):
        if len(declared) != 2 or "null" not in declared:
            raise UnsupportedTypeError(f"field {name!r}: only a union of null and one type is read")
        null_branch = declared.index("null")
        declared = declared[1 - null_branch]
    # A logical type is read as its base type.
    while isinstance(declared, dict):
        declared = declared.get("type")
    if not isinstance(declared, str) or declared not in AVRO_TO_SPARK:
        raise UnsupportedTypeError(f"field {name!r}: Avro type {declared!r} cannot be decoded")
    return Field(name, declared, null_branch)


def record_fields(schema_json: str) -> tuple[Field, ...]:
    """Fields of a flat Avro record, in schema order."""
    try:
        schema = json.loads(schema_json)
    except ValueError as bad:
        raise SchemaConflictError(f"schema text is not JSON: {bad}") from None
    if not isinstance(schema, dict) or schema.get("type") != "record":
        raise UnsupportedTypeError("the top-level Avro type must be a record")
    try:
        return tuple(_field(f["name"], f["type"]) for f in schema["fields"])
    except (KeyError, TypeError) as bad:
        raise UnsupportedTypeError(f"the record has no readable fields: {bad}") from None


def written_names(schemas: Schemas) -> dict[str, str]:
    """The field that a column was made for, of columns that have another name."""
    return {f.name: f.written for fields in readable(schemas).values() for f in fields if f.written is not None}


def _free(name: str, taken: set[str]) -> str:
    while name.lower() in taken:
        name += "_"
    return name


def settle_conflicts(schemas: Schemas) -> Schemas:
    """Schemas whose fields of one name fit one column each.

    A field keeps its name for the types that widen to one with those of smaller ids; a
    field of another type gets a column of its own, named after its type.
    """
    merged: dict[str, str] = {}
    taken = {field.name.lower() for fields in readable(schemas).values() for field in fields}
    own: dict[tuple[str, str], str] = {}
    settled: dict[int, tuple[Field, ...] | None] = {}
    for schema_id, fields in sorted(schemas.items()):
        if fields is None:
            settled[schema_id] = None
            continue
        placed = []
        for field in fields:
            held = merged.get(field.name, field.avro)
            fits = held == field.avro or _WIDER.get(frozenset({held, field.avro}))
            if fits:
                merged[field.name] = held if fits is True else fits
            else:
                column = own.setdefault((field.name, field.avro), _free(f"{field.name}__as_{field.avro}", taken))
                taken.add(column.lower())
                field = field._replace(name=column, written=field.name)
            placed.append(field)
        settled[schema_id] = tuple(placed)
    return settled


def _merge(name: str, left: str, right: str) -> str:
    if left == right:
        return left
    wider = _WIDER.get(frozenset({left, right}))
    if wider is None:
        raise SchemaConflictError(f"field {name!r} is {left} in one schema and {right} in another")
    return wider


def superset(schemas: Schemas) -> dict[str, str]:
    """Field name to Avro type over all schemas, in first-seen order by id."""
    merged: dict[str, str] = {}
    spelling: dict[str, str] = {}
    for _, fields in sorted(readable(schemas).items()):
        seen = set()
        for field in fields:
            folded = field.name.lower()
            if folded in seen or spelling.setdefault(folded, field.name) != field.name:
                raise SchemaConflictError(f"fields that differ only by case: {field.name!r}")
            seen.add(folded)
            known = merged.get(field.name, field.avro)
            merged[field.name] = _merge(field.name, known, field.avro)
    return merged


def superset_type(schemas: Schemas) -> T.StructType:
    merged = superset(schemas)
    return T.StructType([T.StructField(n, AVRO_TO_SPARK[a], True) for n, a in merged.items()])


def presence(schemas: Schemas) -> dict[str, set[int]]:
    """Field name to the schema ids that have it."""
    held: dict[str, set[int]] = {}
    for schema_id, fields in readable(schemas).items():
        for field in fields:
            held.setdefault(field.name, set()).add(schema_id)
    return held
