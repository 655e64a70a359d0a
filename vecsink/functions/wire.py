"""Column functions for one framed record value and its key.

A framed value is one magic byte, a big-endian 32-bit schema id and the Avro
body. Everything here is a built-in expression, so it stays in code generation
and the optimizer can prune or push it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wire format.
MAGIC = 0
HEADER_BYTES = 5


def text(raw: Column) -> Column:
    """Bytes as text; malformed UTF-8 becomes replacement characters."""
    return F.make_valid_utf8(raw.cast("string"))


def has_header(value: Column) -> Column:
    return F.octet_length(value) >= HEADER_BYTES


def has_magic(value: Column) -> Column:
    return F.substring(value, 1, 1) == F.lit(bytes([MAGIC]))


def schema_id(value: Column) -> Column:
    """Signed big-endian int from bytes 1-4; null for a null or short value."""
    unsigned = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    # Shifting up and back down spreads the sign bit of the 32-bit number.
    signed = F.shiftright(F.shiftleft(unsigned, 32), 32)
    return F.when(has_header(value), signed.cast("int"))


def payload(value: Column) -> Column:
    """The Avro body: everything after the header."""
    return F.when(has_header(value), F.substring(value, HEADER_BYTES + 1, 2**31 - 1))


def millis(ts: Column) -> Column:
    """Timestamp cut to milliseconds toward zero.

    `unix_millis` would round down before 1970; the remainder keeps its sign.
    """
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - micros % 1000)


def frame(schema: Column, body: Column) -> Column:
    """Inverse of `schema_id` and `payload`: header plus body."""
    id_bytes = F.unhex(F.lpad(F.right(F.hex(schema.cast("bigint")), F.lit(8)), 8, "0"))
    return F.concat(F.lit(bytes([MAGIC])), id_bytes, body)
