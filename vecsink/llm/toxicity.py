"""A toxicity classifier, regularised by counterfactuals.

A text is the set of its features: each word, and beginnings of it, hashed to slots. A logistic
model is fitted on a bounded sample of labelled texts. For each sampled text that names a group of
people (IDENTITY_TERMS), copies are made with the group swapped for the others of its kind, and squared
differences between the scores of text and copy (before the logistic function) are penalised. So a group's name gets no weight of its own,
and texts that merely mention groups are not taken for toxic.

Features are kept if the sample's texts with them differ enough in their labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.llm.shared import slices, text_column
from vecsink.llm.words import ALNUM_LOWER, U64, find_words, mix, text_of_each

#: Labelled texts that the model is fitted on, those of the smallest hashed doc_id.
TRAINING_TEXTS = 20_000
#: Deviations by which the labels of texts with a feature differ at least from those of all.
LEAST_APART = 3.0
SLOT_BITS = 20
BEGINNINGS = (4, 5, 6, 7, 8, 10)
SWAP_WEIGHT, SHRINK = 1.0, 1e-3

#: Names of groups of people, by kind and language. Fixed values; a caller may give others.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


def _features(hashes: np.ndarray, words) -> np.ndarray:
    """Slots of each word's features (words x kinds)."""
    kinds = [hashes, *(words.prefix(size) for size in BEGINNINGS)]
    return np.stack([mix(k + U64(i)) >> U64(64 - SLOT_BITS) for i, k in enumerate(kinds)], axis=1).astype(np.int64)


def _term_slots(terms) -> dict[int, list[tuple[int, np.ndarray]]]:
    """By a term's hash: the hashes and slots of the terms that it is swapped for, itself first."""
    out = {}
    for group in terms:
        words = find_words(pa.array(list(group), pa.large_string()), ALNUM_LOWER)
        if not (words.count() == 1).all():
            raise ValueError(f"terms must be single words: {group}")
        slots = _features(words.hashes, words)
        for i in range(len(group)):
            order = [i, *(j for j in range(len(group)) if j != i)]
            out.setdefault(int(words.hashes[i]), [(int(words.hashes[j]), slots[j]) for j in order])
    return out


def _sets(texts: pa.Array, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, object]:
    """Distinct slots of each text, of the kept ones if they are given, and the number of the text of each."""
    words = find_words(texts, ALNUM_LOWER)
    slots = _features(words.hashes, words)
    owner = np.repeat(text_of_each(words.first), slots.shape[1])
    slots = slots.ravel()
    if kept is not None:
        used = np.flatnonzero(kept[slots])
        slots, owner = slots[used], owner[used]
    pair = np.unique((owner << SLOT_BITS) | slots)
    return pair & ((1 << SLOT_BITS) - 1), pair >> SLOT_BITS, words


def _swapped(words, terms: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Text, slots that a swap removes, slots that it adds. All places of one term are swapped at once."""
    at = np.flatnonzero(np.isin(words.hashes, np.array(list(terms), dtype=U64)))
    owner = text_of_each(words.first)[at]
    for text, term in sorted(set(zip(owner.tolist(), words.hashes[at].tolist(), strict=True))):
        own, *others = terms[term]
        for _, slots in others:
            yield text, own[1], slots


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sampled texts with each slot, by label."""
    many = np.zeros((2, 1 << SLOT_BITS), dtype=np.int64)
    for batch in batches:
        texts, label = text_column(batch), batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in slices(texts):
            slot, owner, _ = _sets(texts.slice(a, b - a))
            np.add.at(many, (label[a:b][owner], slot), 1)
    used = np.flatnonzero(many.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(many[0, used]), pa.array(many[1, used])], ["slot", "clean", "toxic"])


def _examples(batches: Iterator[pa.RecordBatch], kept: np.ndarray, terms: dict) -> Iterator[pa.RecordBatch]:
    """Kept features of each sampled text, and of what swaps change in it."""
    place = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept), dtype=np.int32)
    for batch in batches:
        texts, label = text_column(batch), batch.column("toxic")
        for a, b in slices(texts):
            slot, owner, words = _sets(texts.slice(a, b - a), place >= 0)
            slot = place[slot]
            offsets = np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32)
            out, into = [[] for _ in range(b - a)], [[] for _ in range(b - a)]
            for text, less, more in _swapped(words, terms):
                out[text].append([int(x) for x in place[less] if x >= 0])
                into[text].append([int(x) for x in place[more] if x >= 0])
            yield pa.RecordBatch.from_arrays(
                [label.slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), pa.array(slot)), *(pa.array(x, pa.list_(pa.list_(pa.int32()))) for x in (out, into))],
                ["toxic", "slots", "swapped_out", "swapped_in"],
            )


@dataclass
class Model:
    """Kept slots with their weights, and the bias."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        dense = np.zeros(1 << SLOT_BITS)
        dense[self.slots] = self.weights
        slot, owner, _ = _sets(texts, dense != 0)
        total = np.bincount(owner, weights=dense[slot], minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    """Values of lists, or of an Arrow column of lists, and the number of the list of each."""
    column = lists if isinstance(lists, pa.ChunkedArray) else pa.chunked_array([pa.array(lists, pa.list_(pa.int32()))])
    parts = [np.asarray(chunk.flatten()) for chunk in column.chunks]
    sizes = np.concatenate([np.asarray(chunk.value_lengths()) for chunk in column.chunks] or [np.zeros(0, dtype=np.int64)])
    return np.concatenate(parts or [np.zeros(0)]).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)


def fit(features, labels: np.ndarray, swaps: list[tuple[list[int], list[int]]], width: int, swap_weight: float = SWAP_WEIGHT, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise logistic loss, counterfactual differences and squared weights.

    features: for each text a list of its features. swaps: for each swapped copy the features that it lacks
    and those that it has instead. Labels weigh by the inverse root of their number, so rare toxic texts count.
    """
    value, row = _flat(features)
    gone, gone_row = _flat([x for x, _ in swaps])
    come, come_row = _flat([x for _, x in swaps])
    n, toxic = len(labels), max(1, int(labels.sum()))
    weigh = np.where(labels == 1, ((n - toxic + 1) / toxic) ** 0.5, 1.0)
    weigh /= weigh.sum()
    w, bias = np.zeros(width + 1), 0.0
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, rounds + 1):
        bias = w[-1]
        score = np.bincount(row, weights=w[value], minlength=n) + bias
        slope = weigh * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels)
        grad = np.bincount(value, weights=slope[row], minlength=width + 1) + 2 * SHRINK / width**0.5 * w
        grad[-1] = slope.sum()
        if swaps:
            gap = np.bincount(come_row, weights=w[come], minlength=len(swaps)) - np.bincount(gone_row, weights=w[gone], minlength=len(swaps))
            pull = 2 * swap_weight * gap / len(swaps)
            grad += np.bincount(come, weights=pull[come_row], minlength=width + 1) - np.bincount(gone, weights=pull[gone_row], minlength=width + 1)
        # Adam: steps of one size for frequent and rare features.
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        w = w - 0.1 * (1 - step / (rounds + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
    return w[:-1], float(w[-1])


def train(documents: DataFrame, labels: DataFrame, terms=IDENTITY_TERMS, sample: int = TRAINING_TEXTS) -> Model:
    """A model from `toxic` of labels (doc_id, toxic) and the texts of documents.

    Rows of labels with a null doc_id or a toxic other than 0 and 1 are not used; of several for one
    document the larger counts. At most `sample` labels are used. Without labels every text gets the same score, below one half.
    """
    usable = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id").select("text", "toxic")
    counts = texts.mapInArrow(_counted, "slot long, clean long, toxic long").groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # How far the share of toxic texts with a feature is from that of all, in deviations.
    totals = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    if totals.n == 0 or totals.t == 0:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), -5.0)
    share = totals.t / totals.n
    seen = F.col("clean") + F.col("toxic")
    apart = F.abs(F.col("toxic") - seen * share) / F.sqrt(seen * F.lit(share * (1 - share) + 1e-9))
    group_slots = sorted({int(s) for others in _term_slots(terms).values() for _, slots in others for s in slots})
    chosen = counts.where(seen >= 2).withColumn("apart", apart).where(F.col("apart") >= LEAST_APART).select("slot").toArrow()
    present = counts.where(F.col("slot").isin(group_slots)).select("slot").toArrow() if group_slots else chosen
    kept = np.unique(np.concatenate([chosen.column("slot").to_numpy(), present.column("slot").to_numpy(), np.array(group_slots, dtype=np.int64)]))
    slots = _term_slots(terms)
    rows = texts.mapInArrow(lambda it: _examples(it, kept, slots), "toxic int, slots array<int>, swapped_out array<array<int>>, swapped_in array<array<int>>").toArrow()
    swaps = [pair for outs, ins in zip(rows.column("swapped_out").to_pylist(), rows.column("swapped_in").to_pylist(), strict=True) for pair in zip(outs, ins, strict=True)]
    weights, bias = fit(rows.column("slots"), rows.column("toxic").to_numpy().astype(np.float64), swaps, len(kept))
    return Model(kept, weights, bias)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of documents, and score (0 to 1, higher: likelier toxic).

    Only text decides, and only it goes to Python. A null or empty text has no features and gets the model's score of none.
    A column named score is replaced.
    """

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        whole = texts.cast(pa.large_string()).fill_null("")
        return pa.array(np.concatenate([np.zeros(0), *(model.score(whole.slice(a, b - a)) for a, b in slices(whole))]))

    # A filter on the score must not be moved below the call, or texts would be scored twice.
    return documents.withColumn("score", scored.asNondeterministic()(F.col("text").cast("string")))
