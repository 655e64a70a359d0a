"""Licence notices in documents by an exact set-similarity join.

Templates are notices' words as sets. A text block (a line, overlapping windows of a long line, or
overlapping windows of the whole text, since notices are wrapped) holds a template if at least `share` of the template's words are in it. All words of templates
are counted in all documents and ordered from rare to frequent. A block that holds a template of
n words, k of them needed, has one of the template's n - k + 1 rarest words: this prefix is
joined. Length and position of a common word bound what can be common; what remains is verified on whole sets.
A template found in a block tells nothing where a larger one that holds all its words is found too.
Where another label's notice alone would hold enough of a template's words, those by which the two differ must be there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecsink.llm.shared import slices, text_column
from vecsink.llm.words import ALNUM_LOWER, find_words, text_of_each

#: Share of a template's words that a block must hold.
SHARE = 0.9
#: Words of a block at most; longer lines are windows that begin every half of it. Windows of a whole text are
#: twice this for templates of over half of it, and so on.
BLOCK_WORDS = 64

#: Phrases whose words stand one after the other. Fixed values.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices and their labels. Fixed values; a caller may give others, whole notices too.
TEMPLATES = (
    ("licensed under the mit license", "mit"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license", "apache"),
    ("licensed under the gnu general public license version", "gpl"),
    ("redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("licensed under the mozilla public license version 2 0", "mpl"),
    ("licensed under the bsd 3 clause license", "bsd"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("dedicated to the public domain under cc0 1 0 universal", "cc0"),
)


def _words(text: str) -> list[str]:
    return list(dict.fromkeys(text.split()))


def _hashes(words: list[str]) -> np.ndarray:
    return find_words(pa.array(words, pa.large_string()), ALNUM_LOWER).hashes


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: list[str]) -> Iterator[pa.RecordBatch]:
    """Places of each template word in a partition's texts."""
    hashes = _hashes(vocabulary)
    order = np.argsort(hashes)
    total = np.zeros(len(vocabulary), dtype=np.int64)
    for batch in batches:
        texts = text_column(batch)
        for a, b in slices(texts):
            words = find_words(texts.slice(a, b - a), ALNUM_LOWER).hashes
            at = np.minimum(np.searchsorted(hashes[order], words), len(hashes) - 1)
            known = hashes[order][at] == words
            total += np.bincount(order[at[known]], minlength=len(vocabulary))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocabulary))), pa.array(total)], ["word", "n"])


def word_order(documents: DataFrame, vocabulary: list[str]) -> list[str]:
    """Template words from rare to frequent in all documents; the driver gets one number for each."""
    counts = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(lambda it: _counted(it, vocabulary), "word long, n long")
    total = {row.word: row.n for row in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return [vocabulary[k] for k in sorted(range(len(vocabulary)), key=lambda k: (total.get(k, 0), vocabulary[k]))]


def _needed(size: int, share: float) -> int:
    return int(np.ceil(share * size - 1e-9))


BLOCKS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("width", pa.int32()), ("words", pa.list_(pa.int32()))]))


def _width(text: str) -> int:
    """Words of the windows that hold a template: it and the step between two windows fit."""
    width = BLOCK_WORDS
    while width // 2 < len(text.split()):
        width *= 2
    return width


def _scanned(batches: Iterator[pa.RecordBatch], phrases, ordered: list[str], prefix: dict[int, list[int]]) -> Iterator[pa.RecordBatch]:
    """Phrases of each text, and its blocks with a prefix word: their template words by rank."""
    hashes = _hashes(ordered)
    by_hash = np.argsort(hashes)
    in_prefix = np.zeros((len(prefix), len(ordered) + 1), dtype=bool)
    for row, ranks in zip(in_prefix, prefix.values(), strict=True):
        row[ranks] = True
    wanted = [(_hashes(phrase.split()), label) for phrase, label in phrases]
    half = BLOCK_WORDS // 2
    for batch in batches:
        texts, ids = text_column(batch), batch.column("doc_id")
        for a, b in slices(texts):
            words = find_words(texts.slice(a, b - a), ALNUM_LOWER)
            h, text = words.hashes, text_of_each(words.first)
            n = b - a
            places, labels = [], [set() for _ in range(n)]
            for sequence, label in wanted:
                m = len(sequence)
                if len(h) < m:
                    continue
                hit = text[: len(h) - m + 1] == text[m - 1 :]
                for k, x in enumerate(sequence):
                    hit &= h[k : len(h) - m + 1 + k] == x
                at = np.flatnonzero(hit)
                places.append(at)
                for t in np.unique(text[at]).tolist():
                    labels[t].add(label)
            place = np.sort(np.concatenate(places)) if places else np.zeros(0, dtype=np.int64)
            owner = text[place]
            many = np.bincount(owner, minlength=n)
            low, high = np.searchsorted(owner, np.arange(n)), np.searchsorted(owner, np.arange(n), side="right") - 1
            has = many > 0
            first = [int(place[low[t]] - words.first[t]) if has[t] else None for t in range(n)]
            last = [int(place[high[t]] - words.first[t]) if has[t] else None for t in range(n)]

            at = np.minimum(np.searchsorted(hashes[by_hash], h), len(hashes) - 1)
            rank = np.where(hashes[by_hash][at] == h, by_hash[at], len(ordered))
            found = [[] for _ in range(n)]
            begins = set()
            for width, wanted_ranks in zip(prefix, in_prefix, strict=True):
                at = np.flatnonzero(wanted_ranks[rank])
                step = width // 2
                offset = (at - words.first[text[at]]) // step
                for t, k in set(zip(text[at].tolist(), offset.tolist(), strict=True)):
                    for window in {k, max(0, k - 1)}:
                        begin = int(words.first[t]) + window * step
                        begins.add((begin, int(min(words.first[t + 1], begin + width)), width))
            seeds = np.flatnonzero(in_prefix[0][rank]) if BLOCK_WORDS in prefix else np.zeros(0, dtype=np.int64)
            if len(seeds):
                breaks = np.flatnonzero(words.data == 10)
                line = np.searchsorted(breaks, words.start)
                fresh = np.ones(len(h), dtype=bool)
                fresh[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
                head = np.flatnonzero(fresh)
                stop = np.append(head[1:], len(h))
                k = np.searchsorted(head, seeds, side="right") - 1
                inside = seeds - head[k]
                for line_at, offset in zip(k.tolist(), inside.tolist(), strict=True):
                    if stop[line_at] - head[line_at] <= BLOCK_WORDS:
                        begins.add((int(head[line_at]), int(stop[line_at]), BLOCK_WORDS))
                    else:
                        for step in {offset // half, max(0, offset // half - 1)}:
                            begin = int(head[line_at]) + step * half
                            begins.add((begin, int(min(stop[line_at], begin + BLOCK_WORDS)), BLOCK_WORDS))
            for begin, end, width in sorted(begins):
                ranks = np.unique(rank[begin:end])
                found[int(text[begin])].append((begin, end, width, ranks[ranks < len(ordered)].tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(a, n), pa.array(words.count().astype(np.int64)), pa.array(many.astype(np.int64)), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                    pa.array([sorted(x) for x in labels], pa.list_(pa.string())), pa.array([[dict(zip(("begin", "end", "width", "words"), x)) for x in row] for row in found], BLOCKS),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"],
            )


def scan(documents: DataFrame, templates=TEMPLATES, phrases=PHRASES, share: float = SHARE) -> DataFrame:
    """Licence labels of documents, by phrases and by templates.

    Returns doc_id, n_words, n_base (places of phrases), first_word and last_word (their smallest and
    largest start in words, null without any), base_labels (of phrases), labels (of phrases and templates;
    both sorted arrays), and score: 1 with a phrase, else the largest share of a template found, else 0. One row for
    each row of documents. Null or empty texts have no words and no labels. Other columns are not read.
    """
    sets = [(label, _words(text)) for text, label in templates]
    if any(not words for _, words in sets):
        raise ValueError("templates need words")
    widths = [_width(text) for text, _ in templates]
    ordered = word_order(documents, sorted({w for _, words in sets for w in words}))
    rank = {word: k for k, word in enumerate(ordered)}
    rows, prefix = [], {width: set() for width in sorted(set(widths))}
    for number, (label, words) in enumerate(sets):
        ranks = sorted(rank[w] for w in words)
        # The one word that tells a notice from that of another label may not be the one that is missing.
        alike = [set(other) for kind, other in sets if kind != label and len(set(words) & set(other)) >= _needed(len(ranks), share)]
        must = sorted({rank[w] for other in alike for w in words if w not in other})
        larger = [k for k, (_, other) in enumerate(sets) if set(words) < set(other)]
        need = _needed(len(ranks), share)
        for place, word in enumerate(ranks[: len(ranks) - need + 1]):
            # A wider block tells of smaller templates too, which a larger one may explain.
            for width in prefix:
                if width >= widths[number]:
                    prefix[width].add(word)
            rows.append((word, number, label, place, need, ranks, larger, widths[number], must))
    narrow = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    ranked = {width: sorted(words) for width, words in prefix.items()}
    scanned = narrow.mapInArrow(
        lambda it: _scanned(it, phrases, ordered, ranked),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, blocks array<struct<begin: long, end: long, width: int, words: array<int>>>",
    )
    kept = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    spread = scanned.withColumn("row_id", F.monotonically_increasing_id()).select("row_id", *kept, F.posexplode_outer("blocks").alias("line", "block"))
    spread = spread.select("row_id", *kept, "line", "block.begin", "block.end", F.col("block.width").alias("block_width"), F.col("block.words").alias("block"))
    spread = spread.select("*", F.posexplode_outer("block").alias("at", "word"))
    # The templates' prefixes are a parameter, so their size does not grow with the data.
    joined = spread.join(F.broadcast(_prefixes(documents.sparkSession, rows)), "word", "left")
    common = F.size(F.array_intersect("block", "template"))
    left = F.least(F.size("template") - F.col("place"), F.size("block") - F.col("at"))
    # A wider block than a template's own only serves to find it where its own block lies in it.
    holds = (F.col("width") <= F.col("block_width")) & (F.size("block") >= F.col("need")) & (left + F.least("place", "at") >= F.col("need")) & (common >= F.col("need"))
    holds &= F.size(F.array_intersect("block", "must")) == F.size("must")
    hit = F.struct("line", "begin", "end", "number", "label", "larger", "width", "block_width", (common / F.size("template")).alias("share"))
    grouped = joined.groupBy("row_id").agg(*(F.first(c).alias(c) for c in kept), F.collect_set(F.when(holds, hit)).alias("hits"))
    beaten = lambda x: F.exists("hits", lambda y: ((y["line"] == x["line"]) | (y["width"] > x["width"]) & (y["begin"] <= x["begin"]) & (y["end"] >= x["end"])) & F.array_contains(x["larger"], y["number"]))
    grouped = grouped.withColumn("hits", F.filter("hits", lambda x: (x["width"] == x["block_width"]) & ~beaten(x)))
    return grouped.select(
        *kept,
        F.sort_array(F.array_union("base_labels", F.transform("hits", lambda x: x["label"]))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("hits", lambda x: x["share"])), F.lit(0.0))).alias("score"),
    )


def _prefixes(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, "word int, number int, label string, place int, need int, template array<int>, larger array<int>, width int, must array<int>")
