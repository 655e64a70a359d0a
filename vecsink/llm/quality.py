"""A quality classifier that reads bytes: a small convolutional network in NumPy.

A text is a row of bytes, cut into chunks of CHUNK bytes that overlap by half and together cover all of it. Each byte
becomes a learned vector; learned filters over WIDTH bytes are laid every STRIDE bytes. In a chunk the largest
value of each filter is kept, so a chunk that says little fires few filters. A hidden layer turns these values into units; their
mean and maximum over all chunks of a text give one probability.

The network is fitted by Adam on a bounded sample: SAMPLE labelled texts, and of each PARTS chunks that are spread
evenly over the whole text. Scoring reads all chunks of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.llm.shared import text_column

#: Labelled texts that the network is fitted on, those of the smallest hashed doc_id, and chunks of each.
SAMPLE, PARTS = 4_096, 24
#: Bytes of a chunk, of a filter, and from one filter place to the next. Chunks begin every half chunk.
CHUNK, WIDTH, STRIDE = 128, 8, 2
HALF = CHUNK // 2
#: Numbers for a byte, filters, and units of the hidden layer.
DEPTH, FILTERS, HIDDEN = 8, 32, 16
#: Fitting: steps, texts in a step, largest change in a step, weight of squared parameters.
STEPS, TEXTS, RATE, SHRINK = 500, 32, 5e-3, 1e-5
#: Bytes that are convolved at once, so that memory does not grow with a text.
GROUP = 1 << 17
#: The byte that stands behind the end of a text.
NONE = 256


@dataclass
class Network:
    """Vectors of bytes, filters, the hidden layer and the output."""

    vectors: np.ndarray  # 257 x DEPTH
    filters: np.ndarray  # WIDTH * DEPTH x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray  # 2 * HIDDEN
    out_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def places(self, codes: np.ndarray) -> np.ndarray:
        """What each filter place reads: rows of WIDTH byte vectors, of codes that are WIDTH - STRIDE longer than the places need."""
        seen = self.vectors[codes]
        count = (len(codes) - WIDTH) // STRIDE + 1
        step = seen.strides[0]
        return np.lib.stride_tricks.as_strided(seen, (count, WIDTH * DEPTH), (STRIDE * step, seen.strides[1]), writeable=False)

    def halves(self, codes: np.ndarray) -> np.ndarray:
        """Largest value of each filter over the places of each half chunk."""
        values = np.ascontiguousarray(self.places(codes)) @ self.filters
        return values.reshape(-1, HALF // STRIDE, FILTERS).max(axis=1)

    def pooled(self, data: np.ndarray) -> np.ndarray:
        """Mean and maximum of the units over all chunks of one text's bytes."""
        chunks = max(1, -(-len(data) // HALF) - 1)
        total, largest, last = np.zeros(HIDDEN), np.zeros(HIDDEN, dtype=np.float32), None
        for first in range(0, chunks + 1, GROUP // HALF):
            many = min(GROUP // HALF, chunks + 1 - first)
            codes = np.full(many * HALF + WIDTH - STRIDE, NONE, dtype=np.int64)
            part = data[first * HALF : first * HALF + len(codes)]
            codes[: len(part)] = part
            found = self.halves(codes)
            found = found if last is None else np.concatenate([last, found])
            units = self.units(np.maximum(found[1:], found[:-1]))
            total += units.sum(axis=0, dtype=np.float64)
            largest = np.maximum(largest, units.max(axis=0, initial=0))
            last = found[-1:]
        return np.concatenate([total / chunks, largest])

    def units(self, top: np.ndarray) -> np.ndarray:
        """The hidden layer on the largest filter values of chunks."""
        return np.maximum(np.maximum(top + self.bias, 0) @ self.hidden + self.hidden_bias, 0)

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        # Summed row by row, so that a score does not depend on the texts beside it.
        return 1 / (1 + np.exp(-np.clip((pooled * self.out).sum(axis=1) + self.out_bias[0], -30, 30)))

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of quality 1 for each text."""
        count = len(texts)
        if not count:
            return np.zeros(0)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + count + 1]
        body = texts.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
        return self.probability(np.stack([self.pooled(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]))


def fresh(seed: int = 11) -> Network:
    """A network with small random numbers, the same on each run."""
    draw = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        return (draw.standard_normal(shape) * (2 / shape[0]) ** 0.5).astype(np.float32)

    vectors = draw.standard_normal((NONE + 1, DEPTH)).astype(np.float32) * np.float32(0.5)
    zeros = [np.zeros(n, dtype=np.float32) for n in (FILTERS, HIDDEN, 1)]
    return Network(vectors, normal(WIDTH * DEPTH, FILTERS), zeros[0], normal(FILTERS, HIDDEN), zeros[1], normal(2 * HIDDEN), zeros[2])


def sample_chunks(data: np.ndarray, most: int = PARTS) -> np.ndarray:
    """At most so many chunks, spread evenly from the first to the last, with the bytes that a filter reads beyond a chunk."""
    chunks = max(1, -(-len(data) // HALF) - 1)
    picked = np.unique(np.linspace(0, chunks - 1, min(most, chunks)).round().astype(np.int64))
    out = np.full((len(picked), CHUNK + WIDTH - STRIDE), NONE, dtype=np.int16)
    for row, chunk in enumerate(picked.tolist()):
        part = data[chunk * HALF : chunk * HALF + out.shape[1]]
        out[row, : len(part)] = part
    return out


def gradients(net: Network, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean logistic loss of some texts, given as chunks and the text of each, and its slope for each part of the network."""
    texts, many = len(labels), len(chunks)
    size = np.bincount(owner, minlength=texts).astype(np.float32)[:, None]
    seen = net.vectors[chunks]
    step = seen.strides
    places = (CHUNK // STRIDE, WIDTH * DEPTH)
    read = np.lib.stride_tricks.as_strided(seen, (many, *places), (step[0], STRIDE * step[1], step[2]), writeable=False).reshape(-1, places[1])
    values = (read @ net.filters).reshape(many, places[0], FILTERS)
    where = values.argmax(axis=1)
    top = np.take_along_axis(values, where[:, None, :], axis=1)[:, 0] + net.bias
    chunk_values = np.maximum(top, 0)
    units = np.maximum(chunk_values @ net.hidden + net.hidden_bias, 0)
    starts = np.searchsorted(owner, np.arange(texts))
    mean = np.add.reduceat(units, starts, axis=0) / size
    largest = np.maximum.reduceat(units, starts, axis=0)
    pooled = np.concatenate([mean, largest], axis=1)
    logit = np.clip(pooled @ net.out + net.out_bias[0], -30, 30)
    loss = float(np.mean(np.logaddexp(0, logit) - labels * logit))
    # Back from the loss to each part. Of equal maxima each takes its share of the slope.
    d_logit = (1 / (1 + np.exp(-logit)) - labels) / texts
    d_pooled = d_logit[:, None] * net.out[None, :]
    is_top = (units == largest[owner]).astype(units.dtype)
    is_top /= np.add.reduceat(is_top, starts, axis=0)[owner]
    d_units = (d_pooled[owner, :HIDDEN] / size[owner] + d_pooled[owner, HIDDEN:] * is_top) * (units > 0)
    d_top = (d_units @ net.hidden.T) * (top > 0)
    picked = read.reshape(many, places[0], -1)[np.arange(many)[:, None], where]  # chunk x filter x what the filter read there
    d_filters = np.einsum("cfr,cf->rf", picked, d_top, optimize=True)
    d_read = (d_top[:, :, None] * net.filters.T[None]).reshape(many, FILTERS, WIDTH, DEPTH)
    codes = chunks[np.arange(many)[:, None, None], where[:, :, None] * STRIDE + np.arange(WIDTH)].astype(np.int64)
    flat = codes.ravel()
    d_vectors = np.stack([np.bincount(flat, weights=d_read[..., i].ravel(), minlength=NONE + 1) for i in range(DEPTH)], axis=1)
    slopes = [d_vectors, d_filters, d_top.sum(axis=0), chunk_values.T @ d_units, d_units.sum(axis=0), pooled.T @ d_logit, d_logit.sum(keepdims=True)]
    return loss, [s.astype(np.float32) for s in slopes]


def fit(samples: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> Network:
    """A network fitted by Adam on the chunks of texts and their labels (0 or 1); the same inputs give the same network."""
    net, draw = fresh(seed), np.random.default_rng(seed + 1)
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    net.out_bias[0] = np.log(share / (1 - share))
    first, second = ([np.zeros_like(p) for p in net.parts()] for _ in range(2))
    queue = np.zeros(0, dtype=np.int64)
    for step in range(1, steps + 1):
        while len(queue) < TEXTS:
            queue = np.concatenate([queue, draw.permutation(len(samples))])
        batch, queue = queue[:TEXTS], queue[TEXTS:]
        owner = np.repeat(np.arange(TEXTS), [len(samples[i]) for i in batch])
        _, slopes = gradients(net, np.concatenate([samples[i] for i in batch]), owner, labels[batch].astype(np.float32))
        rate = RATE * min(1.0, step / 20) * (1 - step / (steps + 1))
        for part, slope, a, b in zip(net.parts(), slopes, first, second, strict=True):
            slope = slope + SHRINK * part
            a += 0.1 * (slope - a)
            b += 0.01 * (slope * slope - b)
            part -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return net


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sampled chunks of each text, as one value."""
    for batch in batches:
        texts = text_column(batch)
        cut = [sample_chunks(np.frombuffer(t.as_buffer(), dtype=np.uint8)).tobytes() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(cut, pa.binary())], ["doc_id", "quality", "chunks"])


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> Network:
    """A network for `quality` of labels (doc_id, quality), fitted on the texts of documents.

    Rows of labels with a null doc_id or a quality other than 0 and 1 are not used; of several for one document the
    larger counts, and of several texts of one doc_id one is taken. At most `sample` labels are used. Without
    labels the network stays as it was drawn.
    """
    usable = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    drawn = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    kind = dict(documents.dtypes)["doc_id"]
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    # Chunks are cut out where a text lies; only they come to the driver.
    chunks = texts.mapInArrow(_cut, f"doc_id {kind}, quality int, chunks binary")
    rows = chunks.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("chunks").alias("chunks")).orderBy("doc_id").select("quality", "chunks").toArrow()
    if not rows.num_rows:
        return fresh()
    samples = [np.frombuffer(c, dtype=np.int16).reshape(-1, CHUNK + WIDTH - STRIDE) for c in rows.column("chunks").to_pylist()]
    return fit(samples, rows.column("quality").to_numpy().astype(np.float64), steps)


def score(documents: DataFrame, network: Network) -> DataFrame:
    """All columns of documents, and score (0 to 1, higher: likelier of quality 1).

    Only text decides, and only it goes to Python. A null or empty text has the score of a chunk that is empty. A column
    named score is replaced.
    """

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(network.score(texts.cast(pa.large_string()).fill_null("")))

    return documents.withColumn("score", scored(F.col("text").cast("string")))
