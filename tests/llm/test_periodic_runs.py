"""Runs against a comparison of all distances, the transform against sums, odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from vecsink.llm import periodic_runs as runs


def plain_runs(words):
    """(start, length, period), by comparing all words at all distances."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at < len(words) - period:
            end = at
            while end < len(words) - period and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(6, 4 * period):
                found.setdefault((at, end + period), period)
            at = max(end, at + 1)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def plain_kept(words):
    gone = {i for s, l, p in plain_runs(words) for i in range(s + p, s + l)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found_in(texts):
    codes, words, first = runs.numbered_words(pa.array(texts, pa.large_string()))
    out = runs.find_runs(codes, np.unique(first[:-1][np.diff(first) > 0]))
    owner = np.searchsorted(first, out[:, 0], side="right") - 1
    return [[(int(s - first[t]), int(l), int(p)) for s, l, p in out[owner == t]] for t in range(len(texts))]


def test_occurrences_equal_sums_of_squares():
    draw = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks, windows = draw.integers(0, 3, (20, size)), draw.integers(0, 3, (20, 2 * size))
        for row in range(0, 20, 2):
            at = int(draw.integers(0, size))
            windows[row, at : at + size] = blocks[row]
        want = [[not ((windows[r, d : d + size] - blocks[r]) ** 2).sum() for d in range(size)] for r in range(20)]
        assert runs.occurrences(blocks, windows).tolist() == want
    # Products far beyond the prime stay exact.
    large = np.array([[2**40 + 5, 2**41, 7, 2**39]])
    assert runs.occurrences(large, np.concatenate([large + 1, large], axis=1)).tolist() == [[False] * 4]
    rows = draw.integers(0, int(runs.PRIME), (3, 32)).astype(np.uint64)
    assert (runs.inverse_transform(runs.transform(rows)) == rows * np.uint64(32) % runs.PRIME).all()


def test_runs_equal_all_distances():
    draw = random.Random(3)
    for _ in range(300):
        texts = []
        for _ in range(draw.randrange(1, 5)):
            words = [str(draw.randrange(draw.choice([1, 2, 3, 50]))) for _ in range(draw.randrange(120))]
            for _ in range(draw.randrange(3)):
                if len(words) > 8:
                    period, at = draw.randrange(1, len(words) // 4 + 1), draw.randrange(len(words))
                    for i in range(at + period, min(len(words), at + draw.randrange(3 * period, 6 * period))):
                        words[i] = words[i - period]
            texts.append(" ".join(words))
        assert found_in(texts) == [plain_runs(t.split()) for t in texts]


@pytest.mark.parametrize(
    "words",
    [["a"] * 5, ["a"] * 6, ["a"] * 4000, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"], (["a"] * 10 + ["b"]) * 5, (["a"] * 500 + ["b"]) * 6 + ["a"] * 300,
     [bin(i).count("1") % 2 for i in range(3000)], [str(i) for i in range(700)] * 5, [str(i) for i in range(511)] * 4 + ["x"], (["a"] * 7 + ["b"] * 7) * 9],
)
def test_hard_words(words):
    words = [str(w) for w in words]
    assert found_in([" ".join(words), "x", " ".join(words)]) == [plain_runs(words), [], plain_runs(words)]


def test_time_grows_in_line():
    import time

    def seconds(words):
        codes = np.unique(np.array(words), return_inverse=True)[1].astype(np.int64)
        began = time.perf_counter()
        runs.find_runs(codes, np.array([0]))
        return time.perf_counter() - began

    for make in (lambda n: [1] * n, lambda n: ([1] * 900 + [2]) * (n // 901), lambda n: list(range(n // 6)) * 6):
        assert seconds(make(160_000)) < 10 * max(seconds(make(40_000)), 0.1)


def test_a_sum_that_is_a_multiple_of_the_prime_by_chance(monkeypatch):
    """All places taken for occurrences: comparing words refutes them."""
    monkeypatch.setattr(runs, "occurrences", lambda blocks, windows: np.ones(blocks.shape, dtype=bool))
    draw = random.Random(4)
    for _ in range(20):
        words = [str(draw.randrange(2)) for _ in range(80)]
        assert found_in([" ".join(words)])[0] == plain_runs(words)


def test_odd_rows(spark, odd_documents, no_documents):
    frame = odd_documents.unionByName(odd_documents.limit(1).selectExpr("77L AS doc_id", "repeat('na na  NA ', 9) AS text", *[f"`{c}`" for c in odd_documents.columns[2:]]))
    found = runs.periodic_runs(frame)
    assert found.columns == ["doc_id", "n_words", "runs", "kept_text"]
    texts = {r.doc_id: r.text or "" for r in frame.collect()}
    rows = found.collect()
    assert len(rows) == frame.count()
    for row in rows:
        words = texts[row.doc_id].split() if row.doc_id != 5 else []
        assert row.n_words == len(words)
        if row.doc_id != 6:
            assert ([tuple(r) for r in row.runs], row.kept_text) == (plain_runs(words), plain_kept(words))
    long = next(r for r in rows if r.doc_id == 6)
    assert [tuple(r) for r in long.runs] == [(0, 17 * 3000, 17)] and long.kept_text == " ".join(texts[6].split()[:17])
    assert runs.periodic_runs(no_documents).collect() == []
    assert runs.with_planted_runs(no_documents).collect() == []


def test_best_run_and_planted_runs(spark):
    import zlib

    rows = [(1, [(0, 6, 1), (9, 12, 2), (30, 24, 4), (60, 7, 1)]), (2, []), (3, [(5, 12, 2), (9, 12, 2), (9, 6, 1)])]
    frame = spark.createDataFrame(rows, f"doc_id long, runs {runs.RUNS}")
    best = {r.doc_id: r.best and tuple(r.best) for r in frame.select("doc_id", runs.best_run(frame.runs).alias("best")).collect()}
    assert best == {1: (60, 7, 1), 2: None, 3: (5, 12, 2)}
    draw = random.Random(8)
    texts = [(i, " ".join(str(draw.randrange(9)) for _ in range(draw.randrange(60)))) for i in range(300)] + [(None, "a b"), (301, None)]
    found = {r.doc_id: r.text for r in runs.with_planted_runs(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for doc, text in texts:
        h = zlib.crc32(str(doc).encode())
        words = (text or "").split()
        if doc is not None and h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            assert found[doc].split() == [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        else:
            assert found[doc] == text
