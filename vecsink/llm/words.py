"""Words of many texts at once, as positions and 64-bit hashes in NumPy.

A slice of texts is one byte array. A word is a run of bytes that are not separators and
belong to one text. Its hash is a polynomial over its bytes, taken from prefix sums, then mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers, from the SplitMix64 generator.
MIX_A, MIX_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
GAMMA = U64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer."""
    x = values + GAMMA
    x ^= x >> U64(30)
    x *= MIX_A
    x ^= x >> U64(27)
    x *= MIX_B
    x ^= x >> U64(31)
    return x


def constants(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=U64) + U64(seed) * GAMMA)


@dataclass(frozen=True)
class Alphabet:
    """Which bytes part words, and whether A-Z counts as a-z."""

    separators: bytes
    lower: bool

    def tables(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        values = constants(256, seed)
        if self.lower:
            values[65:91] = values[97:123]
        parts = np.zeros(256, dtype=bool)
        parts[np.frombuffer(self.separators, dtype=np.uint8)] = True
        return values, parts


SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Words between white space, as they are.
SPACED = Alphabet(SPACES, lower=False)
#: Words between white space, A-Z as a-z.
SPACED_LOWER = Alphabet(SPACES, lower=True)
#: Words of digits, letters and all that is not ASCII, A-Z as a-z.
ALNUM_LOWER = Alphabet(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)


@dataclass
class Words:
    """Words of a slice: byte positions, hash, and the text that each belongs to."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # for each text its first word, and one entry more
    _sums: np.ndarray
    _inverse: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def prefix(self, size: int) -> np.ndarray:
        """Hash of each word's first bytes."""
        end = np.minimum(self.end, self.start + size)
        return mix((self._sums[end] - self._sums[self.start]) * self._inverse[self.start] + U64(size))


def _powers(count: int, base: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64, by doubling."""
    out = np.ones(max(1, count), dtype=U64)
    done, step = 1, U64(base)
    while done < count:
        more = min(done, count - done)
        out[done : done + more] = out[:more] * step
        done += more
        step = step * step
    return out


_BASES = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
_kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def power_tables(count: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    have = _kept.get(which)
    if have is None or len(have[0]) < count:
        size = max(count, 1 << 16)
        base = _BASES[which]
        have = (_powers(size, base), _powers(size, pow(base, -1, 1 << 64)))
        if size <= 1 << 22:
            _kept[which] = have
    return have[0][:count], have[1][:count]


def find_words(texts: pa.Array, alphabet: Alphabet, which: int = 0) -> Words:
    """Words of a large_string array without nulls. which: one of two independent hashes."""
    with np.errstate(over="ignore"):
        count = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + count + 1]
        body = texts.buffers()[2]
        whole = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
        data = whole[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        values, parts = alphabet.tables(which + 1)
        size = len(data)
        inside = np.zeros(size + 1, dtype=bool)
        np.logical_not(parts[data], out=inside[:size])
        begins = inside[:size].copy()
        begins[1:] &= ~inside[: size - 1]
        edges = offsets[:-1][np.diff(offsets) > 0]
        begins[edges] = inside[edges]
        start = np.flatnonzero(begins)
        stops = inside[:size].copy()
        stops[:-1] &= ~inside[1:size]
        lasts = offsets[1:][np.diff(offsets) > 0] - 1
        stops[lasts] = inside[lasts]
        end = np.flatnonzero(stops) + 1
        power, inverse = power_tables(size + 1, which)
        sums = np.zeros(size + 1, dtype=U64)
        np.cumsum(values[data] * power[:size], out=sums[1:])
        hashes = mix((sums[end] - sums[start]) * inverse[start])
        first = np.searchsorted(start, offsets, side="left")
        return Words(data, start, end, hashes, first, sums, inverse)


def text_of_each(first: np.ndarray) -> np.ndarray:
    """For each word the number of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def numbered_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Number of each word, the words by number, and for each text its first word and one entry more."""
    count = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + count + 1]
    body = texts.buffers()[2]
    data = (np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8))[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~SPACED.tables(1)[1][data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    start = np.flatnonzero(begins)
    # Without separators the bytes are the words one after another.
    packed = data[inside]
    where = np.cumsum(inside)[start] - 1 if len(start) else np.zeros(0, dtype=np.int64)
    ends = np.append(where, len(packed)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.searchsorted(start, offsets, side="left")
