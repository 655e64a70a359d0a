"""Values as an object may hold them: type rules, null defaults, RFC3339 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecsink.functions.avro import UnsupportedTypeError

# Types an object may not hold, and the type to cast to instead.
CAST_ADVICE = {
    T.ByteType: "int",
    T.ShortType: "int",
    T.FloatType: "double",
}
ARRAY_CAST_ADVICE = {
    T.FloatType: "array<double>",
    T.LongType: "array<int>",
}

# First and last instant with a four-digit year, in microseconds.
FIRST_MICROS = -62_167_219_200_000_000
LAST_MICROS = 253_402_300_799_999_999


def rfc3339_date(day: Column) -> Column:
    """A date as midnight UTC."""
    return F.concat(day.cast("string"), F.lit("T00:00:00Z"))


def rfc3339_timestamp(ts: Column) -> Column:
    """UTC text with seconds and only as much of the fraction as needed.

    The instant is moved to a zone-free timestamp first, so the session time
    zone and its clock changes play no part. Years outside 0..9999 raise.
    """
    micros = F.unix_micros(ts)
    zone_free = F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))
    written = F.concat(F.replace(zone_free.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    outside = F.raise_error(F.concat(F.lit("year outside 0..9999 in timestamp "), ts.cast("string")))
    return F.when(micros.between(FIRST_MICROS, LAST_MICROS), written).when(ts.isNotNull(), outside.cast("string"))


def _advice(name: str, given: T.DataType) -> UnsupportedTypeError:
    target = CAST_ADVICE.get(type(given))
    if isinstance(given, T.ArrayType):
        target = ARRAY_CAST_ADVICE.get(type(given.elementType))
    hint = f"; cast it to {target}" if target else ""
    return UnsupportedTypeError(f"column {name!r} has type {given.simpleString()}, which an object cannot hold{hint}")


def default_for(given: T.DataType) -> Column | None:
    """What a null of this type becomes; None where nulls stay null."""
    if isinstance(given, T.StringType):
        return F.lit("")
    if isinstance(given, T.BooleanType):
        return F.lit(False)
    if isinstance(given, T.IntegerType):
        return F.lit(0)
    if isinstance(given, T.DoubleType):
        return F.lit(0.0)
    if isinstance(given, T.ArrayType):
        return F.array().cast(T.ArrayType(given.elementType))
    return None


def check_field(name: str, given: T.DataType) -> None:
    """Raise if an object cannot hold the type."""
    element = given.elementType if isinstance(given, T.ArrayType) else None
    scalar = (T.StringType, T.BooleanType, T.IntegerType, T.LongType, T.DoubleType, T.DateType, T.TimestampType)
    if element is None and isinstance(given, scalar):
        return
    if isinstance(element, (T.DoubleType, T.IntegerType, T.StringType)):
        return
    raise _advice(name, given)


def validate_types(schema: T.StructType, vector: str | None = None) -> None:
    """Check every column before any row moves."""
    for field in schema.fields:
        if vector is not None and field.name.lower() == vector.lower():
            check_vector(field)
        else:
            check_field(field.name, field.dataType)


def check_vector(field: T.StructField) -> None:
    element = getattr(field.dataType, "elementType", None)
    if not isinstance(element, (T.FloatType, T.DoubleType)):
        raise UnsupportedTypeError(
            f"vector column {field.name!r} has type {field.dataType.simpleString()}; "
            "it must be array<float> or array<double>"
        )


def convert_value(value: Column, given: T.DataType) -> Column:
    """The value in the form an object holds, nulls left alone."""
    if isinstance(given, T.DateType):
        return rfc3339_date(value)
    if isinstance(given, T.TimestampType):
        return rfc3339_timestamp(value)
    if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.StringType):
        return F.transform(value, lambda item: F.coalesce(item, F.lit("")))
    return value


def convert_column(field: T.StructField, present: Column | None = None, value: Column | None = None) -> Column:
    """One column under the rules for its type.

    `present` says which rows have the field at all: a row without it keeps a
    null, a row that has it gets the default of its type instead of a null.
    """
    check_field(field.name, field.dataType)
    column = convert_value(F.col(f"`{field.name}`") if value is None else value, field.dataType)
    default = default_for(field.dataType)
    if default is None:
        return column
    filled = F.coalesce(column, default)
    return filled if present is None else F.when(present, filled)


def as_vector(value: Column) -> Column:
    return value.cast("array<float>")
