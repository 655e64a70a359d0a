"""Avro bodies to and from Arrow columns, a whole batch at a time.

Used inside Arrow UDF tasks. The reader holds one cursor per row and moves all
cursors through one field after another, so the number of Python steps depends
on the number of fields and not on the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vecsink.functions.avro import Field, Schemas

# Fixed values of the Avro binary encoding.
VARINT_BYTES = {"int": 5, "long": 10}
FIXED = {"float": np.dtype("<f4"), "double": np.dtype("<f8"), "boolean": np.dtype("u1")}

# Result field that says whether a body was read; no Avro name can look like it.
OK = "ok?"

_NUMPY = {"int": np.int32, "long": np.int64, "float": np.float32, "double": np.float64, "boolean": np.bool_}


class Cursors:
    """A read position per row over bodies that lie in one shared buffer."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.at, self.end = data, start.copy(), end
        self.bad = np.zeros(len(start), dtype=bool)

    def alive(self, rows: np.ndarray) -> np.ndarray:
        return rows[~self.bad[rows]]

    def varint(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Zig-zag integers of at most `width` bytes; bad rows read as 0."""
        raw = np.zeros(len(rows), dtype=np.uint64)
        at, end = self.at[rows], self.end[rows]
        open_ = np.arange(len(rows))
        for step in range(width):
            inside = at[open_] < end[open_]
            if not inside.all():
                self.bad[rows[open_[~inside]]] = True
                open_ = open_[inside]
            if not len(open_):
                break
            byte = self.data[at[open_]]
            raw[open_] |= (byte & 0x7F).astype(np.uint64) << np.uint64(7 * step)
            at[open_] += 1
            open_ = open_[byte > 0x7F]
            if not len(open_):
                break
        self.bad[rows[open_]] = True
        self.at[rows] = at
        if width == VARINT_BYTES["int"]:
            raw &= np.uint64(0xFFFFFFFF)
        return (raw >> np.uint64(1)).astype(np.int64) ^ -(raw & np.uint64(1)).astype(np.int64)

    def fixed(self, rows: np.ndarray, kind: np.dtype) -> np.ndarray:
        """Little-endian values of a fixed width; bad rows read as 0."""
        inside = self.at[rows] + kind.itemsize <= self.end[rows]
        self.bad[rows[~inside]] = True
        out = np.zeros(len(rows), dtype=kind)
        good = rows[inside]
        spread = self.at[good][:, None] + np.arange(kind.itemsize)
        out[inside] = self.data[spread].view(kind).ravel()
        self.at[good] += kind.itemsize
        return out

    def span(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of a length-prefixed run of bytes."""
        length = self.varint(rows, VARINT_BYTES["long"])
        start = self.at[rows]
        fits = (length >= 0) & (length <= self.end[rows] - start) & ~self.bad[rows]
        self.bad[rows[~fits]] = True
        length = np.where(fits, length, 0)
        self.at[rows] = start + length
        return start, length


class _Slot:
    """Output of one column of the superset, filled schema by schema."""

    def __init__(self, avro: str, base: np.ndarray):
        self.avro = avro
        self.valid = np.zeros(len(base), dtype=bool)
        if avro in ("string", "bytes"):
            self.start, self.length = base.copy(), np.zeros(len(base), dtype=np.int64)
        else:
            self.values = np.zeros(len(base), dtype=_NUMPY[avro])

    def arrow(self, data: pa.Buffer) -> pa.Array:
        if self.avro not in ("string", "bytes"):
            return pa.array(self.values, mask=~self.valid)
        # Rows and fields lie in ascending order in the buffer, so spans and the
        # gaps between them form one binary array; every second item is a span.
        count = len(self.start)
        edges = np.empty(2 * count, dtype=np.int32)
        edges[0::2], edges[1::2] = self.start, self.start + self.length
        runs = pa.Array.from_buffers(pa.binary(), max(2 * count - 1, 0), [None, pa.py_buffer(edges), data])
        return runs.take(pa.array(np.arange(0, 2 * count, 2), mask=~self.valid))


def _read_field(cursors: Cursors, rows: np.ndarray, field: Field, slot: _Slot | None) -> None:
    rows = cursors.alive(rows)
    if field.null_branch is not None:
        branch = cursors.varint(rows, VARINT_BYTES["long"])
        cursors.bad[rows[(branch != 0) & (branch != 1)]] = True
        rows = rows[(branch == 1 - field.null_branch) & ~cursors.bad[rows]]
    if field.avro in ("string", "bytes"):
        start, length = cursors.span(rows)
        if slot is not None:
            slot.start[rows], slot.length[rows] = start, length
    else:
        if field.avro in VARINT_BYTES:
            values = cursors.varint(rows, VARINT_BYTES[field.avro])
        else:
            values = cursors.fixed(rows, FIXED[field.avro])
        if slot is not None:
            slot.values[rows] = values
    if slot is not None:
        slot.valid[rows] = True


def decode_bodies(
    ids: pa.Array, bodies: pa.Array, schemas: Schemas, wanted: Mapping[str, str]
) -> pa.StructArray:
    """Bodies of several schemas to one struct of `wanted` fields plus `OK`.

    String fields come out as bytes. Bytes after the last field are ignored. A
    row whose schema id is not in `schemas`, or whose body is null or ends too
    early, gets nulls and a false `OK`.
    """
    bodies = bodies.cast(pa.binary())
    count = len(bodies)
    _, edge_buffer, data = bodies.buffers()
    if data is None:
        data = pa.py_buffer(b"")
    if edge_buffer is None or not count:
        edges = np.zeros(count + 1, dtype=np.int64)
    else:
        edges = np.frombuffer(edge_buffer, dtype=np.int32)[bodies.offset : bodies.offset + count + 1]
        edges = edges.astype(np.int64)
    cursors = Cursors(np.frombuffer(data, dtype=np.uint8), edges[:-1], edges[1:])
    slots = {name: _Slot(avro, edges[:-1]) for name, avro in wanted.items()}

    present = bodies.is_valid().to_numpy(zero_copy_only=False)
    row_ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    present &= ids.is_valid().to_numpy(zero_copy_only=False)
    known = np.zeros(count, dtype=bool)
    for schema_id in np.unique(row_ids[present]):
        fields = schemas.get(int(schema_id))
        if fields is None:
            continue
        rows = np.flatnonzero(present & (row_ids == schema_id))
        known[rows] = True
        for field in fields:
            _read_field(cursors, rows, field, slots.get(field.name))

    ok = known & ~cursors.bad
    for slot in slots.values():
        slot.valid &= ok
    arrays = [slot.arrow(data) for slot in slots.values()] + [pa.array(ok)]
    return pa.StructArray.from_arrays(arrays, names=[*slots, OK])


def _packed(matrix: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary array of the first `lengths[i]` bytes of each matrix row."""
    edges = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=edges[1:])
    data = np.ascontiguousarray(matrix[np.arange(matrix.shape[1]) < lengths[:, None]])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(edges), pa.py_buffer(data)])


def encode_varint(values: np.ndarray) -> pa.Array:
    signed = values.astype(np.int64)
    rest = (signed.astype(np.uint64) << np.uint64(1)) ^ (signed >> np.int64(63)).astype(np.uint64)
    matrix = np.zeros((len(rest), VARINT_BYTES["long"]), dtype=np.uint8)
    lengths = np.ones(len(rest), dtype=np.int64)
    for step in range(VARINT_BYTES["long"]):
        matrix[:, step] = (rest & np.uint64(0x7F)).astype(np.uint8)
        rest = rest >> np.uint64(7)
        more = rest > 0
        matrix[more, step] |= 0x80
        lengths += more
        if not more.any():
            break
    return _packed(matrix, lengths)


def _encode_present(field: Field, column: pa.Array) -> pa.Array:
    if field.avro in ("string", "bytes"):
        raw = column.cast(pa.binary())
        sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False)
        return pc.binary_join_element_wise(encode_varint(sizes), raw, b"")
    values = column.to_numpy(zero_copy_only=False)
    if field.avro in VARINT_BYTES:
        return encode_varint(values)
    flat = np.ascontiguousarray(values.astype(FIXED[field.avro]))
    width = flat.dtype.itemsize
    return _packed(flat.view(np.uint8).reshape(len(flat), width), np.full(len(flat), width))


def encode_bodies(fields: tuple[Field, ...], columns: list[pa.Array]) -> pa.Array:
    """Avro bodies for one schema; a null in a field without union is an error."""
    parts = []
    for field, column in zip(fields, columns, strict=True):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if field.null_branch is None:
            if column.null_count:
                raise ValueError(f"null in field {field.name!r}, which has no null branch")
            parts.append(_encode_present(field, column))
            continue
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        parts.append(encode_varint(np.where(valid, 1 - field.null_branch, field.null_branch)))
        # Nulls contribute no bytes: encode what is there and spread it back.
        packed = _encode_present(field, column.drop_null())
        where = pa.array(np.cumsum(valid) - 1, mask=~valid)
        parts.append(packed.take(where).fill_null(b""))
    return pc.binary_join_element_wise(*parts, b"")
