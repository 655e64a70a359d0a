"""Repeated word windows, found by recompression.

Words of all texts are compressed in rounds. A round names each maximal run of one symbol, then
each pair of a left and a right symbol; a seeded bit of its name decides on which side a symbol
stands. Names are hashes of what they stand for, so all executors give the same names without
exchanging a dictionary, and equal substrings get equal symbols but near their ends. For each
symbol the words that its being there depends on are tracked (its reach). A window of 13 words
thus always holds a symbol of the second round whose reach lies inside it, or it touches a run.

1. Reveal: a symbol goes by a hash of all words in its reach, at most ten if there is no run. Each
   window picks, of the symbols whose reach it holds, the least; so equal windows pick equal symbols. A window without one picks itself. Picked symbols are
   dealt out by name; those of two documents are shared.
2. Verify: windows that picked a shared symbol are compared by two independent 64-bit hashes of
   all their words; the smallest doc_id with a window is its owner.
3. Remove: words in a window that a smaller doc_id owns.

A symbol that several documents of one slice share is sent once for all of them, so very
frequent passages do not meet in one task. Only texts that a Bloom filter of fixed size finds
among those with shared symbols are shuffled. Texts that are copies of a smaller doc_id's text
lose all words that windows cover and are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.llm.shared import id_filter, slices, stored, text_column, with_maybe
from vecsink.llm.words import SPACED, U64, constants, find_words, mix, power_tables, text_of_each

ROUNDS = 2
_FAR = np.iinfo(np.int64).max


def _runs(name, low, high, text):
    """Each maximal run of one symbol becomes a symbol; a single symbol keeps its name."""
    n = len(name)
    same = (name[1:] == name[:-1]) & (text[1:] == text[:-1])
    begin = np.flatnonzero(np.concatenate([[True], ~same]))
    stop = np.append(begin[1:], n)
    # A symbol's being maximal depends on its neighbours; at the edge of a text, on that edge.
    before, after = np.maximum(begin - 1, 0), np.minimum(stop, n - 1)
    lo = np.where((begin > 0) & (text[before] == text[begin]), low[before], low[begin] - 1)
    hi = np.where((stop < n) & (text[after] == text[begin]), high[after], high[stop - 1] + 1)
    length = (stop - begin).astype(U64)
    named = np.where(length > 1, mix(name[begin] + length * constants(1, 71)[0]), name[begin])
    return named, lo, hi, text[begin]


def _pairs(name, low, high, text, turn):
    """Each left symbol and the right symbol after it become a symbol."""
    n = len(name)
    left = (mix(name ^ constants(1, 100 + turn)[0]) & U64(1)).astype(bool)
    joined = np.zeros(n, dtype=bool)
    joined[:-1] = left[:-1] & ~left[1:] & (text[1:] == text[:-1])
    tail = np.zeros(n, dtype=bool)
    tail[1:] = joined[:-1]
    at = np.flatnonzero(~tail)
    nxt, prv = np.minimum(at + 1, n - 1), np.maximum(at - 1, 0)
    has_next, has_prev = (at + 1 < n) & (text[nxt] == text[at]), (at > 0) & (text[prv] == text[at])
    pair = joined[at]
    # A left symbol stays alone for its right neighbour's sake, a right one for its left neighbour's.
    lo = np.where(pair | left[at], low[at], np.where(has_prev, low[prv], low[at] - 1))
    hi = np.where(pair, high[nxt], np.where(~left[at], high[at], np.where(has_next, high[nxt], high[at] + 1)))
    first, second = constants(2, 200 + turn)
    named = np.where(pair, mix(name[at] * (first | U64(1)) + mix(name[nxt] ^ second)), name[at])
    return named, lo, hi, text[at]


def symbols(hashes: np.ndarray, text: np.ndarray, rounds: int = ROUNDS):
    """Name, first and last word of the reach, and text of each symbol after all rounds.

    A reach that leaves its text means that the text's edge counts.
    """
    with np.errstate(over="ignore"):
        at = np.arange(len(hashes), dtype=np.int64)
        state = (hashes, at, at, text)
        if len(hashes):
            for turn in range(rounds):
                state = _pairs(*_runs(*state), turn)
        return state


def window_hashes(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of each window of so many consecutive words of a slice."""
    count = max(0, len(hashes) - size + 1)
    factor = constants(size, seed) | U64(1)
    with np.errstate(over="ignore"):
        out = np.zeros(count, dtype=U64)
        for k in range(size):
            out = mix(out + hashes[k : k + count] * factor[k]) if k % 4 == 3 else out + hashes[k : k + count] * factor[k]
        return mix(out)


def _reach_names(hashes, first, low, high, owner):
    """A hash of the words in each reach; none where it leaves its text."""
    n = len(hashes)
    with np.errstate(over="ignore"):
        power, inverse = power_tables(n + 1, 1)
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(hashes * power[:n], out=sums[1:])
        lo, hi = np.clip(low, 0, n - 1), np.clip(high, 0, n - 1)
        name = mix((sums[hi + 1] - sums[lo]) * inverse[lo] + (hi - lo).astype(U64))
    return np.where((low >= first[owner]) & (high < first[owner + 1]), name, U64(0))


def picks(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows inside one text: first word, text, and the name of the symbol that each picks."""
    text = text_of_each(first)
    n = len(hashes)
    start = np.arange(max(0, n - size + 1), dtype=np.int64)
    start = start[text[start] == text[start + size - 1]] if len(start) else start
    if not len(start):
        return start, start, np.zeros(0, dtype=U64)
    _, low, high, owner = symbols(hashes, text)
    name = _reach_names(hashes, first, low, high, owner)
    # Both ends of the reach grow from symbol to symbol, so a window holds a range of symbols.
    begin = np.searchsorted(low, start, side="left")
    stop = np.searchsorted(high, start + size - 1, side="right")
    order = mix(name)
    best, who = np.full(len(start), _FAR, dtype=U64), np.full(len(start), -1, dtype=np.int64)
    for k in range(int((stop - begin).max(initial=0))):
        at = np.minimum(begin + k, len(name) - 1)
        better = (begin + k < stop) & ((order[at] < best) | (who < 0))
        best, who = np.where(better, order[at], best), np.where(better, at, who)
    # A window in which no symbol's reach lies picks itself.
    alone = window_hashes(hashes, size, 31)[start]
    picked = np.where(who >= 0, name[np.maximum(who, 0)], alone)
    return start, text[start], picked


def _sent(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Distinct picked symbols of each document; of those shared within a slice one is dealt by name."""
    texts, ids = text_column(batch), batch.column("doc_id").cast(pa.int64())
    for a, b in slices(texts):
        words = find_words(texts.slice(a, b - a), SPACED)
        _, text, name = picks(words.hashes, words.first, size)
        own = ids.slice(a, b - a)
        doc = own.fill_null(0).to_numpy(zero_copy_only=False)[text]
        known = np.asarray(own.is_valid())[text]
        order = np.lexsort((doc[known], name[known]))
        name, doc = name[known][order], doc[known][order]
        new_name = np.concatenate([[True], name[1:] != name[:-1]]) if len(name) else np.zeros(0, bool)
        new = new_name.copy()
        new[1:] |= doc[1:] != doc[:-1]
        name, doc, head = name[new], doc[new], new_name[new]
        alone = head & np.append(head[1:], True) if len(head) else head
        # The first row of a name goes where the name is dealt; the rest, already known as shared, anywhere.
        key = np.where(head, name, mix(name ^ doc.astype(U64))).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(name.view(np.int64)), pa.array(doc), pa.array(~alone), pa.array(head)], ["key", "name", "doc_id", "shared", "dealt"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those of a symbol that two documents have."""
    held = None  # the one row of the last symbol while nothing tells that it is shared
    last, last_shared = None, False
    for batch in batches:
        key, name, doc = (batch.column(c).to_numpy() for c in ("key", "name", "doc_id"))
        shared, dealt = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shared", "dealt"))
        apart = np.flatnonzero(~dealt)
        out = [(name[apart], doc[apart])]
        key, name, doc, shared = key[dealt], name[dealt], doc[dealt], shared[dealt]
        if len(key):
            begin = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
            lengths = np.diff(np.append(begin, len(name)))
            low, high = np.minimum.reduceat(doc, begin), np.maximum.reduceat(doc, begin)
            common = np.logical_or.reduceat(shared, begin) | (low != high)
            if last is not None and name[0] == last:
                meets = last_shared or bool(common[0]) or (held is not None and held[1] != doc[0])
                if meets and held is not None:
                    out.append((np.array([held[0]]), np.array([held[1]])))
                    held = None
                common[0] = meets
            elif last is not None:
                held = None
            keep = np.repeat(common, lengths)
            out.append((name[keep], doc[keep]))
            last, last_shared = name[-1], bool(common[-1])
            if last_shared:
                held = None
            elif held is None or held[0] != last:
                held = (name[-1], doc[-1])
        names, docs = (np.concatenate(x) for x in zip(*out, strict=True))
        if len(names):
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(names)], ["doc_id", "name"])


def shared_symbols(documents: DataFrame, size: int) -> DataFrame:
    """doc_id and the picked symbols that another document has too."""
    sent = documents.select("doc_id", "text").mapInArrow(lambda it: (out for b in it for out in _sent(b, size)), "key long, name long, doc_id long, shared boolean, dealt boolean")
    return sent.repartition("key").sortWithinPartitions("key", "name").mapInArrow(_met, "doc_id long, name long")


_KEPT = ["doc_id", "n_words", "n_removed", "kept_text", "rest"]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded bytes, so that its texts are not held in several forms at once."""
    for a, b in slices(text_column(batch)):
        yield batch.slice(a, b - a)


def _plain(batch: pa.RecordBatch, whole: bool) -> pa.RecordBatch:
    """Documents that keep all their words."""
    counts, kept = [], []
    for text in text_column(batch).cast(pa.large_binary()).to_pylist():
        words = text.split()
        counts.append(len(words))
        kept.append(text if whole else b" ".join(words))
    columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(np.zeros(len(counts), dtype=np.int64)), pa.array(kept, pa.binary()).cast(pa.string()), batch.column("rest")]
    return pa.RecordBatch.from_arrays(columns, _KEPT)


def _found(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Texts and number of words, with the windows that picked a shared symbol."""
    texts, names, copy = text_column(batch), batch.column("names"), batch.column("copy").to_numpy(zero_copy_only=False)
    salt = constants(1, 45)[0] | U64(1)
    for a, b in slices(texts):
        part = texts.slice(a, b - a)
        words, second = find_words(part, SPACED), find_words(part, SPACED, 1)
        start, text, name = picks(words.hashes, words.first, size)
        own = names.slice(a, b - a)
        shared = own.flatten().to_numpy().view(U64)
        lengths = np.asarray(own.value_lengths().fill_null(0)) * ~copy[a:b]
        shared = shared[np.repeat(~copy[a:b], np.asarray(own.value_lengths().fill_null(0)))]
        with np.errstate(over="ignore"):
            wanted = mix(shared + np.repeat(np.arange(b - a, dtype=U64), lengths) * salt)
            keep = np.isin(mix(name + text.astype(U64) * salt), wanted)
        start, text = start[keep], text[keep]
        one, two = (window_hashes(x.hashes, size, seed)[start].view(np.int64) for x, seed in ((words, 41), (second, 43)))
        offsets = pa.array(np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32))
        within = (start - words.first[text]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (within, one, two)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").slice(a, b - a), part.cast(pa.string()), pa.array(words.count().astype(np.int64)), pa.array(copy[a:b]), *lists, batch.column("rest").slice(a, b - a)],
            ["doc_id", "text", "n_words", "copy", "starts", "h1", "h2", "rest"],
        )


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows sorted by hashes and doc_id, those that a smaller doc_id has too."""
    last = None  # hashes and owner of the window that the batch before ended with
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two, doc = (batch.column(c).to_numpy() for c in ("h1", "h2", "doc_id"))
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        owners = doc[new]
        if last is not None and (one[0], two[0]) == last[:2]:
            owners[0] = last[2]
        last = one[-1], two[-1], owners[-1]
        keep = pa.array(owners[np.cumsum(new) - 1] < doc)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("row_id", "starts")], ["row_id", "starts"])


def _removed(batch: pa.RecordBatch, size: int, whole: bool) -> pa.RecordBatch:
    """What is kept of documents with lost windows, and of copies."""
    texts = text_column(batch).cast(pa.large_binary()).to_pylist()
    starts, copy = batch.column("lost"), batch.column("copy").to_pylist()
    lost, kept = [], []
    for i, text in enumerate(texts):
        words = text.split()
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        if copy[i] and len(words) >= size:
            edge[0] = 1
        elif starts[i].is_valid:
            at = np.unique(starts[i].values.to_numpy())
            edge[at] += 1
            np.add.at(edge, at + size, -1)
        covered = np.cumsum(edge[:-1]) > 0
        lost.append(int(covered.sum()))
        kept.append(text if whole and not lost[-1] else b" ".join(w for w, x in zip(words, covered.tolist(), strict=True) if not x))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(lost, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), batch.column("rest")], _KEPT)


def remove_repeats(documents: DataFrame, size: int = 13, columns: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """Remove each word in a window of `size` words that also starts in a smaller doc_id.

    Returns doc_id, n_words, n_removed, kept_text (kept words, one space between; with `whole` a text
    that loses nothing stays as it is) and the named columns, one row for each row of documents.
    Windows are judged on the input. A null text has no words and becomes empty. A row
    without doc_id keeps its words and takes none from others. Rows that share a doc_id do not
    take words from each other. Columns that are not named are not read.
    """
    if size < 11:
        raise ValueError("windows of fewer than 11 words may hold no symbol of the second round")
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.struct(*columns) if columns else F.lit(True)).alias("rest"))
    rest = dict(narrow.dtypes)["rest"]
    kept = f"doc_id long, n_words long, n_removed long, kept_text string, rest {rest}"
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    hashed = narrow.select("doc_id", digest.alias("digest"))
    owner = hashed.groupBy("digest").agg(F.min("doc_id").alias("owner"))
    copies = hashed.join(owner, "digest").where(F.col("doc_id") > F.col("owner"))
    copies = copies.groupBy("doc_id").agg(F.collect_set("digest").alias("copied"))
    names = shared_symbols(narrow.select("doc_id", "text"), size).groupBy("doc_id").agg(F.collect_set("name").alias("names"))
    known = stored(copies.join(names, "doc_id", "full"), "shared-symbols")
    told = with_maybe(narrow, "doc_id", id_filter(known, "doc_id"))
    plain = told.where("not maybe").select("doc_id", "text", "rest").mapInArrow(lambda it: (_plain(p, whole) for b in it for p in _parts(b)), kept)
    # By text too: rows with one doc_id may hold different texts.
    marked = told.where("maybe").join(known, "doc_id", "left")
    marked = marked.select("doc_id", "text", "rest", "names", F.coalesce(F.array_contains("copied", digest), F.lit(False)).alias("copy"))
    found = marked.mapInArrow(
        lambda it: (out for b in it for out in _found(b, size)),
        "doc_id long, text string, n_words long, copy boolean, starts array<int>, h1 array<long>, h2 array<long>, rest " + rest,
    )
    found = stored(found.withColumn("row_id", F.monotonically_increasing_id()), "windows")
    windows = found.select("doc_id", "row_id", F.explode(F.arrays_zip("starts", "h1", "h2")).alias("w")).select("doc_id", "row_id", "w.*")
    # One shuffle for owners and losers; a window that all documents have passes its task as a stream.
    dealt = windows.repartition("h1").sortWithinPartitions("h1", "h2", "doc_id")
    lost = dealt.mapInArrow(_owned, "row_id long, starts int").groupBy("row_id").agg(F.collect_list("starts").alias("lost"))
    lost = stored(lost, "lost-windows")
    told = with_maybe(found.select("row_id", "doc_id", "n_words", "text", "copy", "rest"), "row_id", id_filter(lost, "row_id"))
    # Copies lose what windows cover without being compared, so they need no join either.
    spared = told.where("not maybe or copy").withColumn("lost", F.lit(None).cast("array<int>"))
    ended = told.where("maybe and not copy").join(lost, "row_id", "left")
    cut = lambda frame: frame.select("doc_id", "n_words", "text", "copy", "lost", "rest").mapInArrow(lambda it: (_removed(p, size, whole) for b in it for p in _parts(b)), kept)
    every = plain.union(cut(spared)).union(cut(ended))
    return every.select("doc_id", "n_words", "n_removed", "kept_text", *(F.col("rest")[c].alias(c) for c in columns))
