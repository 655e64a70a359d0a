"""The byte network: slopes against differences, a plain reading of the network, held-out rows, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows_of

from vecsink.llm import quality


def plain_score(net, text: str) -> float:
    """The network byte by byte, as its description says."""
    data = list(text.encode())
    chunks = max(1, -(-len(data) // quality.HALF) - 1)
    units = []
    for chunk in range(chunks):
        begin = chunk * quality.HALF
        best = [-np.inf] * quality.FILTERS
        for place in range(begin, begin + quality.CHUNK, quality.STRIDE):
            codes = [data[i] if i < len(data) else quality.NONE for i in range(place, place + quality.WIDTH)]
            read = np.concatenate([net.vectors[c] for c in codes])
            best = np.maximum(best, read @ net.filters)
        units.append(np.maximum(np.maximum(best + net.bias, 0) @ net.hidden + net.hidden_bias, 0))
    told = np.concatenate([np.mean(units, axis=0), np.max(units, axis=0)])
    return float(1 / (1 + np.exp(-(told @ net.out + net.out_bias[0]))))


def test_scores_equal_a_plain_reading(monkeypatch):
    net = quality.fresh(5)
    texts = ["", "a", "x" * 63, "y" * 64, "z" * 65, "ab" * 64, "word " * 200, "é日本語 " * 70, "".join(chr(33 + i % 90) for i in range(1000))]
    want = [plain_score(net, t) for t in texts]
    assert np.allclose(net.score(pa.array(texts, pa.large_string())), want, atol=1e-5)
    # A long text is convolved in groups; their seams change nothing.
    monkeypatch.setattr(quality, "GROUP", 2 * quality.HALF)
    assert np.allclose(net.score(pa.array(texts, pa.large_string())), want, atol=1e-5)
    assert net.score(pa.array([], pa.large_string())).tolist() == []


def test_slopes_equal_differences():
    net, draw = quality.fresh(3), np.random.default_rng(0)
    for name in ("vectors", "filters", "bias", "hidden", "hidden_bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    samples = [quality.sample_chunks(draw.integers(0, 255, n).astype(np.uint8)) for n in (40, 1500, 300)]
    chunks, owner = np.concatenate(samples), np.repeat(np.arange(3), [len(s) for s in samples])
    labels = np.array([1.0, 0.0, 1.0])
    _, slopes = quality.gradients(net, chunks, owner, labels)
    for number, (part, slope) in enumerate(zip(net.parts(), slopes, strict=True)):
        for _ in range(5):
            at = tuple(int(draw.integers(0, n)) for n in part.shape)
            at = (int(chunks[1, 5]), at[1]) if number == 0 else at
            value, losses = part[at], []
            for step in (1e-5, -1e-5):
                part[at] = value + step
                losses.append(quality.gradients(net, chunks, owner, labels)[0])
            part[at] = value
            assert slope[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-6)


def test_samples_are_spread_over_whole_texts():
    data = np.arange(100_000) % 251
    cut = quality.sample_chunks(data.astype(np.uint8))
    assert cut.shape == (quality.PARTS, quality.CHUNK + quality.WIDTH - quality.STRIDE)
    assert cut[0, 0] == data[0] and cut[-1, -7:].tolist() == [quality.NONE] * 7
    assert quality.sample_chunks(np.zeros(0, dtype=np.uint8)).tolist() == [[quality.NONE] * cut.shape[1]]


def test_held_out_documents(spark):
    from vecsink.llm.queries import QUALITY_SCORE, QUERIES

    sf = "/root/testdata/sf0.01"
    found = QUERIES["op11_quality"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    right = [(r.score >= QUALITY_SCORE) == (r.quality == 1) for r in found]
    assert len(found) > 50 and sum(right) / len(right) > 0.92
    assert all(r.predicted == int(r.score >= QUALITY_SCORE) for r in found)


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (3, None), (9, 7), (4, 1), (6, 1), (99, 0)], "doc_id long, quality int")
    net = quality.train(odd_documents, labels, steps=3)
    found = quality.score(odd_documents, net)
    assert sorted(found.columns) == sorted(odd_documents.columns)
    rows = rows_of(found, "doc_id", "score")
    assert len(rows) == odd_documents.count() and all(0 <= s <= 1 for _, s in rows)
    by_doc = {}
    for doc, s in rows:
        by_doc.setdefault(doc, set()).add(s)
    # Equal texts have equal scores; null and empty texts are the same.
    assert by_doc[1] == by_doc[2] == by_doc[None] and by_doc[3] == by_doc[4] and by_doc[7] == by_doc[8]
    again = quality.train(odd_documents, labels, steps=3)
    assert all((a == b).all() for a, b in zip(net.parts(), again.parts(), strict=True))
    # No rows, no labels.
    assert quality.score(no_documents, net).collect() == []
    assert quality.train(no_documents, labels).out_bias[0] == 0 and quality.train(odd_documents, labels.where("false")).out_bias[0] == 0
