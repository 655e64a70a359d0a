"""Concatenate and cut: all tokens form one line, which fixed windows cut into sequences.

First pass: each partition tokenizes its documents, gives each the number of tokens before it in
the partition, and is stored. A prefix sum over the partitions' totals then gives every document its place
on the whole line. Second pass: windows of `length` places cut the documents; a document that
crosses a window's edge has a boundary record in each.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecsink.llm.shared import slices, stored, text_column
from vecsink.llm.words import numbered_words

LENGTH = 4096
#: Words of which a task remembers the ids; then it starts anew.
WORDS_KEPT = 600_000
#: Bytes of text whose distinct words are looked up at once.
TEXT_BYTES = 2 << 20


#: Punctuation that may close a word; it stands apart from letters before it in ids as well.
CLOSING = ".,;:!?*#$%&)"
NOTHING = pa.scalar(b"", pa.large_binary())


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is visible, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordCoder:
    """Ids of whole texts, each distinct word encoded once.

    For a byte-level tokenizer that lower-cases and parts words at white space and between
    letters and punctuation, a text's ids are its words' ids, one after the other, and a word of lower-case
    letters goes straight to the vocabulary's merges. Texts are cut at ASCII white space only; words of
    any other make are the tokenizer's to part. Other tokenizers get whole texts.
    """

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.coder = Tokenizer.from_file(path)
        self.end = np.array([end], dtype="<u4").tobytes()
        self.bases: dict[bytes, bytes | None] = {}
        self.wholes: dict[bytes, bytes] = {b"": b""}
        made = json.loads(self.coder.to_str())
        steps = [made["normalizer"] or {}, made["pre_tokenizer"] or {}]
        kinds = [[x["type"] for x in step.get("normalizers", step.get("pretokenizers", []))] for step in steps]
        self.by_word = kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] and made["post_processor"] is None
        self.letters = byte_letters()

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype="<u4").tobytes() for x in self.coder.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, base: bytes) -> bool:
        if base.isascii():
            return base.isalpha()
        text = base.decode()
        return text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)

    def _merged(self, base: bytes) -> bytes:
        text = base.decode() if base.isascii() else "".join(map(self.letters.__getitem__, base))
        return array("I", [x.id for x in self.coder.model.tokenize(text)]).tobytes()

    def _base_ids(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of lower-case words from the merges; None for a word that is not all letters."""
        bases, out = self.bases, []
        for word in words:
            ids = bases.get(word, b"")
            if ids == b"":
                ids = bases[word] = self._merged(word) if self._plain(word) else None
            out.append(ids)
        return out

    def _whole_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that the tokenizer parts itself."""
        new = [word for word in words if word not in self.wholes]
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            self.wholes.update(zip(some, self._encode([word.decode() for word in some]), strict=True))
        return [self.wholes[word] for word in words]

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text of a large_string array, with the end id, as bytes."""
        if not self.by_word:
            return pa.array([body + self.end for body in self._encode(texts.to_pylist())], pa.large_binary())
        if len(self.bases) + len(self.wholes) > WORDS_KEPT:
            self.bases, self.wholes = {}, {b"": b""}
        codes, words, first = numbered_words(texts)
        lower = pc.ascii_lower(words.cast(pa.large_string()))
        base = pc.ascii_rtrim(lower, characters=CLOSING)
        closing = _rests(lower, base).dictionary_encode()
        base = base.cast(pa.large_binary()).dictionary_encode()
        of_base = pa.array(self._base_ids(base.dictionary.to_pylist()), pa.large_binary()).take(base.indices)
        of_closing = pa.array(self._whole_ids(closing.dictionary.to_pylist()), pa.large_binary()).take(closing.indices)
        ids = pc.binary_join_element_wise(of_base, of_closing, NOTHING)
        other = np.flatnonzero(of_base.is_null().to_numpy(zero_copy_only=False))
        if len(other):
            whole = pa.array(self._whole_ids(words.take(pa.array(other)).to_pylist()), pa.large_binary())
            ids = pc.replace_with_mask(ids, of_base.is_null(), whole)
        of_text = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), ids.take(pa.array(codes)))
        return pc.binary_join_element_wise(pc.binary_join(of_text, NOTHING), pa.scalar(self.end, pa.large_binary()), NOTHING)


def _rests(whole: pa.Array, begin: pa.Array) -> pa.Array:
    """What follows the beginning of each text of a fresh large_string array."""
    count = len(whole)
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[: count + 1]
    edges = np.empty(2 * count, dtype=np.int64)
    edges[0::2] = offsets[:-1] + pc.binary_length(begin).to_numpy()
    edges[1::2] = offsets[1:]
    # Rests and the beginnings between them form one array; every second item is a rest.
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), max(0, 2 * count - 1), [None, pa.py_buffer(edges), whole.buffers()[2]])
    return spans.take(pa.array(np.arange(0, 2 * count, 2)))


def _tokenized(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    """Ids of each text with the end id, and the tokens before it in the partition."""
    part, before = TaskContext.get().partitionId(), 0
    coder = WordCoder(path, end)
    for batch in batches:
        texts, ids = text_column(batch), batch.column("doc_id")
        for a, b in slices(texts, TEXT_BYTES):
            bodies = coder.encode(texts.slice(a, b - a))
            counts = pc.binary_length(bodies).to_numpy() // 4
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(np.full(b - a, part, dtype=np.int64)), pa.array(starts), pa.array(counts), bodies.cast(pa.binary())],
                ["doc_id", "part", "start_in_part", "doc_tokens", "ids"],
            )


def _cut(batch: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
    """Pieces of documents: places of one document in one window."""
    places = batch.column("place").to_numpy()
    counts = batch.column("doc_tokens").to_numpy()
    body, doc = batch.column("ids"), batch.column("doc_id")
    first, last = places // length, (places + counts - 1) // length
    many = last - first + 1
    row = np.repeat(np.arange(len(places)), many)
    window = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[row]
    begin = np.maximum(window * length, places[row])
    stop = np.minimum((window + 1) * length, (places + counts)[row])
    pieces = [body[r].as_buffer()[4 * s : 4 * e] for r, s, e in zip(row.tolist(), (begin - places[row]).tolist(), (stop - places[row]).tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays(
        [doc.take(pa.array(row)), pa.array(begin - places[row]), pa.array(stop - begin), pa.array(counts[row]), pa.array(window), pa.array(begin - window * length), pa.array([x.to_pybytes() for x in pieces], pa.binary())],
        ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
    )


def pack(documents: DataFrame, path: str, length: int = LENGTH, end: int = 2) -> DataFrame:
    """Pack the tokens of all documents, each closed by the id `end`, into windows of `length`.

    Returns one row for each piece: doc_id, start (the document's ids before it), length,
    doc_tokens, sequence_id, offset in the sequence, and ids (little-endian unsigned 32-bit).
    All sequences but the last are full. A null or empty text is its end id alone; a row without
    doc_id is packed as any other. Repeated rows are packed each. Other columns are not read.
    """
    narrow = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    coded = narrow.mapInArrow(lambda it: _tokenized(it, path, end), f"doc_id {kind}, part long, start_in_part long, doc_tokens long, ids binary")
    coded = stored(coded, "tokens")
    totals = coded.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row for each partition of the input, so both the window and the broadcast stay small.
    places = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    placed = coded.join(F.broadcast(places), "part").select("doc_id", "doc_tokens", "ids", (F.col("before") + F.col("start_in_part")).alias("place"))
    return placed.mapInArrow(lambda it: (out for b in it for out in _cut(b, length)), f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
