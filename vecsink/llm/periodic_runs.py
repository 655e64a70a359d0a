"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of words with smallest period q, of at least max(6, 4 q) words, that cannot be made
longer. Scale B = 1, 2, 4, ... finds periods q in [B, 2 B). The words are cut into blocks of B. In a run the words that
equal those q further on are at least 3 q in a row, so several whole blocks in a row occur again at distance q, inside the
window of 2 B words that follows each block.

For a block x and its window y, the sum of (x[j] - y[d + j]) ** 2 over j is 0 where the block occurs at d.
Its product term is a correlation, taken for all distances at once by a number-theoretic transform of length 2 B modulo a
prime: integers, no rounding. The sum is exactly 0 modulo the prime wherever the block occurs, so no place is missed; a sum that
is a multiple of the prime by chance is refuted when words are compared.

Distances that enough blocks in a row share are seeds. A seed is extended word by word to both sides. Seeds inside a
run that a smaller scale has found are left out: there their distance is a multiple of that run's period. Seeds that remain are
repetitions of primitive words, of which there are few, so work is in proportion to n log n. Blocks with a word
that does not occur again within 2 B words cannot be in a run of the scale, and are not transformed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecsink.llm.shared import slices, text_column
from vecsink.llm.words import U64, numbered_words, text_of_each

#: 15 * 2 ** 27 + 1 is prime, with the primitive root 31, so lengths up to 2 ** 27 have transforms.
PRIME, ROOT, ORDER_BITS = U64(2013265921), 31, 27
#: A run has LEAST words and TIMES periods at least.
LEAST, TIMES = 6, 4
#: Words that are transformed at once.
GROUP_WORDS = 1 << 18

_roots: dict[tuple[int, bool], np.ndarray] = {}


def _root_powers(size: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of that order, half of them."""
    have = _roots.get((size, inverse))
    if have is None:
        root = pow(ROOT, (int(PRIME) - 1) // size, int(PRIME))
        step = pow(root, -1, int(PRIME)) if inverse else root
        have = np.ones(max(1, size // 2), dtype=U64)
        done = 1
        while done < len(have):
            have[done : 2 * done] = have[:done] * U64(pow(step, done, int(PRIME))) % PRIME
            done *= 2
        if size <= 1 << 16:
            _roots[size, inverse] = have
    return have


def transform(rows: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long); values come out in bit-reversed order."""
    count, size = rows.shape
    out, half = rows, size // 2
    while half:
        out = out.reshape(count, -1, 2, half)
        low, high = out[:, :, 0], out[:, :, 1]
        total = low + high
        total -= PRIME * (total >= PRIME)
        apart = (low + (PRIME - high)) * _root_powers(2 * half, False) % PRIME
        out = np.stack((total, apart), axis=2)
        half //= 2
    return out.reshape(count, size)


def inverse_transform(rows: np.ndarray) -> np.ndarray:
    """What transform() was given, times the length of a row."""
    count, size = rows.shape
    out, half = rows, 1
    while half < size:
        out = out.reshape(count, -1, 2, half)
        low, high = out[:, :, 0], out[:, :, 1] * _root_powers(2 * half, True) % PRIME
        total = low + high
        total -= PRIME * (total >= PRIME)
        apart = low + (PRIME - high)
        apart -= PRIME * (apart >= PRIME)
        out = np.stack((total, apart), axis=2)
        half *= 2
    return out.reshape(count, size)


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each block of B numbers at which places 0 ... B - 1 of its window (2 B numbers) it occurs."""
    count, size = blocks.shape
    x, y = blocks.astype(U64) % PRIME, windows.astype(U64) % PRIME
    padded = np.zeros((count, 2 * size), dtype=U64)
    # A block read backwards makes the product a correlation.
    padded[:, :size] = x[:, ::-1]
    product = inverse_transform(transform(padded) * transform(y) % PRIME)[:, size - 1 : 2 * size - 1]
    squares = np.zeros((count, 2 * size + 1), dtype=U64)
    np.cumsum(y * y % PRIME, axis=1, out=squares[:, 1:])
    own = (x * x % PRIME).sum(axis=1, keepdims=True)
    both = (own + squares[:, size : 2 * size] - squares[:, :size]) % PRIME
    # product carries the factor 2 B of the inverse transform.
    return both * U64(2 * size) % PRIME == product * U64(2) % PRIME


def _next_same(codes: np.ndarray) -> np.ndarray:
    """How far on the same word comes again; the number of words where it does not."""
    order = np.argsort(codes, kind="stable")
    out = np.full(len(codes), len(codes), dtype=np.int64)
    again = np.flatnonzero(codes[order[1:]] == codes[order[:-1]])
    out[order[again]] = order[again + 1] - order[again]
    return out


def _extended(codes: np.ndarray, start: int, stop: int, distance: int) -> tuple[int, int]:
    """The stretch around [start, stop) in which each word equals that at the distance, as [first, last + distance)."""
    step = 16
    while True:
        low, high = max(0, start - step), min(len(codes) - distance, stop + step)
        before = np.flatnonzero(codes[low:start] != codes[low + distance : start + distance])
        after = np.flatnonzero(codes[stop:high] != codes[stop + distance : high + distance])
        first = low + int(before[-1]) + 1 if len(before) else low
        last = stop + int(after[0]) if len(after) else high
        if (len(before) or low == 0) and (len(after) or high == len(codes) - distance):
            return first, last + distance
        start, stop, step = first, last, 2 * step


def _seeds(codes: np.ndarray, far: np.ndarray, size: int, covered: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first word, end of the last block, distance) of blocks in a row that all occur again at a distance in [size, 2 size)."""
    blocks = len(codes) // size
    if not blocks:
        return
    near = np.maximum.reduceat(far[: blocks * size], np.arange(0, blocks * size, size)) < 2 * size
    # At least two blocks in a row take part.
    beside = np.zeros(blocks, dtype=bool)
    beside[1:] |= near[:-1]
    beside[:-1] |= near[1:]
    at = np.flatnonzero(near & beside)
    padded = np.concatenate([codes, np.full(3 * size, -1, dtype=codes.dtype)]) + 2
    places, distances = [], []
    group = max(1, GROUP_WORDS // size)
    for part in (at[i : i + group] for i in range(0, len(at), group)):
        first = part * size
        found = occurrences(padded[first[:, None] + np.arange(size)], padded[first[:, None] + np.arange(size, 3 * size)])
        row, place = np.nonzero(found)
        start, distance = first[row], place + size
        new = covered[start] < start + distance + size
        places.append(start[new])
        distances.append(distance[new])
    if not places:
        return
    start, distance = np.concatenate(places), np.concatenate(distances)
    order = np.lexsort((start, distance))
    start, distance = start[order], distance[order]
    cut = np.ones(len(start), dtype=bool)
    cut[1:] = (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + size)
    heads = np.flatnonzero(cut)
    many = np.diff(np.append(heads, len(start)))
    # Equal words in a row: a run's length less its period.
    least = np.maximum((TIMES - 1) * distance[heads], LEAST - distance[heads])
    for head in np.flatnonzero(many >= (least - size + 1) // size):
        begin = int(start[heads[head]])
        yield begin, begin + int(many[head]) * size, int(distance[heads[head]])


def _equal_blocks(codes: np.ndarray, start: int, stop: int, distance: int, size: int) -> list[tuple[int, int]]:
    """Of blocks in a row those that equal the words at the distance, in rows; a sum may have been a multiple of the prime."""
    stop = min(stop, start + max(0, len(codes) - distance - start) // size * size)
    equal = (codes[start:stop] == codes[start + distance : stop + distance]).reshape(-1, size).all(axis=1)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    return [(start + a * size, start + b * size) for a, b in edges.reshape(-1, 2).tolist()]


def find_runs(codes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """All runs (start, length, period) of numbered words, by start and period. breaks: where a new text begins."""
    count = len(codes)
    if count < LEAST:
        return np.zeros((0, 3), dtype=np.int64)
    # A number of its own before each text keeps runs apart.
    shift = np.searchsorted(breaks, np.arange(count), side="right")
    words = np.arange(count + len(breaks), dtype=np.int64) + int(codes.max()) + 1
    words[np.arange(count) + shift] = codes
    words = np.unique(words, return_inverse=True)[1].astype(np.int64)
    far = _next_same(words)
    longest = int(np.diff(np.append(breaks, count)).max())
    found: set[tuple[int, int, int]] = set()
    covered = np.zeros(len(words), dtype=np.int64)
    size = 1
    while TIMES * size <= longest:
        fresh = set()
        for start, stop, distance in _seeds(words, far, size, covered):
            for first, last in _equal_blocks(words, start, stop, distance, size):
                begin, end = _extended(words, first, last, distance)
                if end - begin >= max(LEAST, TIMES * distance):
                    fresh.add((begin, end, distance))
        for begin, end, _ in fresh:
            covered[begin] = max(covered[begin], end)
        np.maximum.accumulate(covered, out=covered)
        found |= fresh
        size *= 2
    smallest: dict[tuple[int, int], int] = {}
    for begin, end, distance in found:
        smallest[begin, end] = min(distance, smallest.get((begin, end), distance))
    out = sorted((begin, smallest[begin, end], end) for begin, end in smallest)
    runs = np.array([(begin, end - begin, period) for begin, period, end in out], dtype=np.int64).reshape(-1, 3)
    text = np.searchsorted(breaks + np.arange(1, len(breaks) + 1), runs[:, 0], side="right")
    runs[:, 0] -= text
    return runs


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _found(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        texts = text_column(batch)
        for a, b in slices(texts):
            codes, words, first = numbered_words(texts.slice(a, b - a))
            owner = text_of_each(first)
            runs = find_runs(codes, np.unique(first[:-1][np.diff(first) > 0]))
            of_text = owner[runs[:, 0]] if len(runs) else np.zeros(0, dtype=np.int64)
            gone = np.zeros(len(codes) + 1, dtype=np.int64)
            np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
            np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
            kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
            ends = np.searchsorted(kept, first)
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), words.take(pa.array(codes[kept])))
            joined = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
            begins = runs[:, 0] - first[of_text]
            offsets = np.searchsorted(of_text, np.arange(b - a + 1)).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(begins), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(struct))
            part = batch.slice(a, b - a)
            columns = [part.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(offsets), entries), joined.cast(pa.string())], [*names, "n_words", "runs", "kept_text"])


def periodic_runs(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and kept_text of each row's text.

    Words are what stands between white space. kept_text holds the words, joined by one space, without those that
    a run holds behind its first period. A null or empty text has no words and no runs; rows of one doc_id are
    treated each by itself; columns other than doc_id and text are not looked at.
    """
    kind = dict(documents.dtypes)["doc_id"]
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(lambda batches: _found(batches, ["doc_id"]), f"doc_id {kind}, n_words long, runs {RUNS}, kept_text string")


def best_run(runs: Column) -> Column:
    """The run with the most periods, of ties the first, then that of the smallest period; null without runs."""

    def better(best: Column, run: Column) -> Column:
        # Products of lengths and periods are exact; quotients would not be.
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """doc_id and text; where crc32 of the doc_id ends in 0, the words from word a on become repeats of the first p of them."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"), (hashed % 10 == 0).alias("chosen"), F.floor(hashed / 10).alias("g"))
    rows = rows.withColumn("words", F.when(F.col("chosen"), words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    moved = F.transform("words", lambda word, i: F.when(i < F.col("a"), word).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))
