"""Decoded Avro records as VARIANT values, a whole batch at a time.

The layout is that of the published variant format: a record's names lie in its metadata, in order, and its value
holds the numbers of the names, where each field's value begins, and the values. Rows of one schema share all but
the places and the values, so a batch takes a number of Python steps that depends on its fields, not on its rows.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed values of the variant format: the first byte of a value of each Avro type, and its width.
HEADS = {"int": 5 << 2, "long": 6 << 2, "double": 7 << 2, "float": 14 << 2, "bytes": 15 << 2, "string": 16 << 2}
WIDTHS = {"int": np.dtype("<i4"), "long": np.dtype("<i8"), "double": np.dtype("<f8"), "float": np.dtype("<f4")}
NULL, TRUE, FALSE = 0, 1 << 2, 2 << 2

#: How a variant column travels in Arrow.
ARROW = pa.struct([pa.field("value", pa.binary(), nullable=False), pa.field("metadata", pa.binary(), nullable=False, metadata={b"variant": b"true"})])


def _binary(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _rows(matrix: np.ndarray) -> pa.Array:
    """Each row of a byte matrix as a binary value."""
    count, width = matrix.shape
    return _binary(matrix.reshape(-1), np.arange(count + 1, dtype=np.int64) * width)


def valid_text(raw: pa.Array) -> pa.Array:
    """Bytes that are all valid UTF-8; others have what is not valid replaced, as Spark does."""
    try:
        raw.cast(pa.string())
        return raw
    except pa.ArrowInvalid:
        return pa.array([None if b is None else b.decode("utf-8", "replace").encode() for b in raw.to_pylist()], pa.binary())


def encode_field(avro: str, column: pa.Array) -> pa.Array:
    """One field's values; a null is the variant null."""
    count = len(column)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    if avro in ("string", "bytes"):
        raw = column.cast(pa.binary())
        raw = valid_text(raw) if avro == "string" else raw
        head = np.zeros((count, 5), dtype=np.uint8)
        head[:, 0] = HEADS[avro]
        sizes = pc.binary_length(raw).fill_null(0).to_numpy(zero_copy_only=False).astype("<u4")
        head[:, 1:] = sizes.view(np.uint8).reshape(count, 4)
        written = pc.binary_join_element_wise(_rows(head), raw.fill_null(b""), b"")
    elif avro == "boolean":
        truth = column.fill_null(False).to_numpy(zero_copy_only=False)
        written = _rows(np.where(truth, TRUE, FALSE).astype(np.uint8)[:, None])
    else:
        kind = WIDTHS[avro]
        matrix = np.empty((count, 1 + kind.itemsize), dtype=np.uint8)
        matrix[:, 0] = HEADS[avro]
        values = np.ascontiguousarray(column.fill_null(0).to_numpy(zero_copy_only=False).astype(kind))
        matrix[:, 1:] = values.view(np.uint8).reshape(count, kind.itemsize)
        written = _rows(matrix)
    return written if valid.all() else pc.if_else(pa.array(valid), written, pa.scalar(bytes([NULL]), pa.binary()))


def encode_objects(fields: dict[str, tuple[str, pa.Array]], count: int) -> pa.StructArray:
    """Objects of the named fields (Avro type, values), all rows with all of them."""
    names = sorted(fields, key=str.encode)
    texts = [name.encode() for name in names]
    ends = np.cumsum([0, *map(len, texts)])
    # Version 1, sorted names, four bytes for a place.
    metadata = bytes([0x01 | 0x10 | 3 << 6]) + struct.pack("<I", len(names)) + struct.pack(f"<{len(names) + 1}I", *ends.tolist()) + b"".join(texts)
    large = len(names) > 255
    numbers = struct.pack(f"<{len(names)}{'I' if large else 'B'}", *range(len(names)))
    # Four bytes for where a value begins; one or four for a name's number and for how many there are.
    head = bytes([(3 | (3 if large else 0) << 2 | large << 4) << 2 | 2]) + struct.pack("<I" if large else "<B", len(names)) + numbers
    values = [encode_field(*fields[name]) for name in names]
    places = np.zeros((count, len(names) + 1), dtype="<u4")
    for i, column in enumerate(values):
        places[:, i + 1] = places[:, i] + pc.binary_length(column).to_numpy(zero_copy_only=False)
    front = np.empty((count, len(head) + 4 * (len(names) + 1)), dtype=np.uint8)
    front[:, : len(head)] = np.frombuffer(head, dtype=np.uint8)
    front[:, len(head) :] = places.view(np.uint8).reshape(count, 4 * (len(names) + 1))
    written = pc.binary_join_element_wise(_rows(front), *values, b"")
    return pa.StructArray.from_arrays([written, pa.repeat(pa.scalar(metadata, pa.binary()), count)], fields=list(ARROW))
