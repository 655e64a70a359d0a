"""Near copies among embeddings by an inverted multi-index.

Each half of the unit vectors has a codebook of its own; a pair of codewords is a cell of a product
grid. A vector is stored in its own cell. As a query it visits cells in the order of the sum of
its halves' squared distances to the codewords (multi-sequence order), as many as reach the target recall on the links of
sampled queries to all vectors. There it is compared with all stored vectors in double precision. Cells of many
vectors are compared in blocks, which give numbers of links and spanning links, not all links.

Only the codebooks and the number of visits are fitted on a bounded sample; all vectors are indexed. Where even the
whole sample has fewer links than ENOUGH_LINKS, a sixteenth of the cells is visited at least. Equal vectors are one class
with a weight.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.llm.components import components
from vecsink.llm.shared import runs_of, stored

#: Vectors on which codebooks and visits are fitted.
SAMPLE = 8192
#: Vectors of a cell on average, codewords of a half at most, vectors compared at once.
CELL_SIZE, MOST_WORDS, BLOCK = 64, 256, 1024
TARGET_RECALL = 0.999
#: Sampled queries that are compared with all vectors, one number after the other until so many links are known;
#: cells that are visited at least.
QUERIES_ASKED, ENOUGH_LINKS, LEAST_VISITS = (512, 2048, SAMPLE), 1000, 4


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and digest of each usable vector, and its numbers as doubles; null for others."""
    for batch in batches:
        ids, vectors = batch.column("vec_id"), batch.column("embedding")
        sizes, digests, bodies = [], [], []
        for i in range(batch.num_rows):
            body = None
            if ids[i].is_valid and vectors[i].is_valid:
                values = vectors[i].values
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if values.null_count == 0 and len(x) and np.isfinite(x).all() and x.any():
                    body = x.tobytes()
            sizes.append(len(body) // 8 if body else None)
            digests.append(hashlib.md5(body).digest() if body else None)
            bodies.append(body)
        yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(bodies, pa.binary())], ["vec_id", "size", "digest", "body"])


def unit(bodies, size: int) -> np.ndarray:
    """Vectors of one length, scaled to length 1 without overflow."""
    x = np.frombuffer(b"".join(bodies), dtype=np.float64).reshape(-1, size)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _halves(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of vectors, cut or filled to the index's length."""
    if x.shape[1] != size:
        x = np.pad(x[:, :size], ((0, 0), (0, max(0, size - x.shape[1]))))
    return x[:, : size // 2], x[:, size // 2 :]


def _distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * (x @ words.T) + (words * words).sum(1))


def _codebook(x: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spread rows; a codeword without rows stays."""
    words = x[np.linspace(0, len(x) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        own = _distances(x, words).argmin(1)
        total = np.zeros_like(words)
        np.add.at(total, own, x)
        many = np.bincount(own, minlength=count)
        words[many > 0] = total[many > 0] / many[many > 0][:, None]
    return words


@dataclass
class Index:
    """Codebooks of both halves, and how many cells a query visits."""

    size: int
    words: tuple[np.ndarray, np.ndarray]
    visits: int = 1

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The own cell of each vector, and squared distances of both halves to all codewords."""
        one, two = (_distances(h, w) for h, w in zip(_halves(x, self.size), self.words, strict=True))
        return one.argmin(1) * len(self.words[1]) + two.argmin(1), one, two

    def visited(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row and cell of each visit, and each row's largest distance to a visited cell.

        The n-th cell in multi-sequence order has ranks r and s in both halves with (r + 1) * (s + 1) <= n.
        """
        count = min(self.visits, one.shape[1] * two.shape[1])
        first, second = np.argsort(one, axis=1), np.argsort(two, axis=1)
        r, s = (a.ravel() for a in np.meshgrid(np.arange(one.shape[1]), np.arange(two.shape[1]), indexing="ij"))
        few = (r + 1) * (s + 1) <= count
        r, s = r[few], s[few]
        rows = np.arange(len(one))[:, None]
        i, j = first[:, r], second[:, s]
        sums = one[rows, i] + two[rows, j]
        reach = np.partition(sums, count - 1, axis=1)[:, count - 1]
        at, which = np.nonzero(sums <= reach[:, None])
        return at, i[at, which] * two.shape[1] + j[at, which], reach


def fit(sample: np.ndarray, total: int) -> Index:
    """Codebooks for a table of so many vectors."""
    count = max(1, min(MOST_WORDS, len(sample), round((total / CELL_SIZE) ** 0.5)))
    return Index(sample.shape[1], tuple(_codebook(h, count) for h in _halves(sample, sample.shape[1])))


def _ranks(batches: Iterator[pa.RecordBatch], index: Index, queries: np.ndarray, query_ids: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between queries and stored vectors by the visit that finds them: `rank` (from 1) and their number."""
    _, one, two = index.cells(queries)
    width = len(index.words[1])
    known: dict[tuple[int, int], int] = {}
    many = np.zeros(len(index.words[0]) * width + 1, dtype=np.int64)
    for whole in batches:
        for a in range(0, whole.num_rows, BLOCK):
            part = whole.slice(a, BLOCK)
            x = unit(part.column("body").to_pylist(), index.size)
            q, s = np.nonzero((queries @ x.T >= threshold) & (query_ids[:, None] != part.column("id").to_numpy()[None, :]))
            pairs, links = np.unique(np.stack([q, index.cells(x)[0][s]], axis=1), axis=0, return_counts=True)
            for (query, cell), n in zip(pairs.tolist(), links.tolist(), strict=True):
                if (query, cell) not in known:
                    own = one[query, cell // width] + two[query, cell % width]
                    known[query, cell] = int((one[query][:, None] + two[query][None, :] < own).sum()) + 1
                many[known[query, cell]] += n
    used = np.flatnonzero(many)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(many[used])], ["rank", "links"])


def visits_for(index: Index, ranks: np.ndarray, links: np.ndarray) -> int:
    """Visits that find the target recall of known links, given as numbers of links by rank."""
    cells = len(index.words[0]) * len(index.words[1])
    order = np.argsort(ranks)
    found = np.cumsum(links[order])
    if not len(found):
        return min(cells, max(LEAST_VISITS, cells // 16 + 1))
    reached = int(ranks[order][np.searchsorted(found, TARGET_RECALL * found[-1])]) + 1
    # So few links tell of themselves only: what they need is a lower bound.
    least = LEAST_VISITS if found[-1] >= ENOUGH_LINKS else max(LEAST_VISITS, cells // 16 + 1)
    return min(cells, max(least, reached))


def fit_visits(index: Index, classes: DataFrame, sample: np.ndarray, ids: np.ndarray, threshold: float) -> None:
    """Set the visits from links of sampled queries to all vectors.

    Queries are added until enough links are known or the whole sample was asked. Only numbers of links by
    rank come back, at most one for each cell.
    """
    same = classes.where(F.col("size") == index.size).select("id", "body")
    for asked in QUERIES_ASKED:
        queries, query_ids = sample[:asked], ids[:asked]
        found = same.mapInArrow(lambda it: _ranks(it, index, queries, query_ids, threshold), "rank long, links long")  # noqa: B023
        known = found.groupBy("rank").agg(F.sum("links").alias("links")).toArrow()
        ranks, links = known.column("rank").to_numpy(), known.column("links").to_numpy()
        if links.sum() >= ENOUGH_LINKS or asked >= len(sample):
            break
    index.visits = visits_for(index, ranks, links)


def _dealt(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Each vector once as stored, and once for each cell that it visits."""
    for whole in batches:
        for a in range(0, whole.num_rows, 2048):
            batch = whole.slice(a, 2048)
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                cell, one, two = index.cells(unit(part.column("body").to_pylist(), size))
                at, visited, reach = index.visited(one, two)
                rows = np.concatenate([np.arange(len(cell)), at])
                role = np.concatenate([np.zeros(len(cell), bool), np.ones(len(at), bool)])
                taken = part.select(["id", "size", "weight", "body"]).take(pa.array(rows))
                extra = [np.concatenate([cell, visited]).astype(np.int32), role, cell[rows].astype(np.int32), reach[rows]]
                yield pa.RecordBatch.from_arrays([*taken.columns, *map(pa.array, extra)], ["id", "size", "weight", "body", "cell", "query", "own_cell", "reach"])


def _linked(batches: Iterator[pa.RecordBatch], index: Index, threshold: float) -> Iterator[pa.RecordBatch]:
    """For blocks of queries and stored vectors: numbers of links of each vector, and spanning links."""
    for run in runs_of(batches, ["cell", "size", "query_block", "stored_block"]):
        run = run.combine_chunks()
        query = run.column("query").to_numpy(zero_copy_only=False).astype(bool)
        if query.all() or not query.any():
            continue
        x = unit(run.column("body").to_pylist(), run.column("size")[0].as_py())
        ids, weight, own, reach = (run.column(c).to_numpy() for c in ("id", "weight", "own_cell", "reach"))
        q, s = np.flatnonzero(query), np.flatnonzero(~query)
        near = (x[q] @ x[s].T >= threshold) & (ids[q][:, None] != ids[s][None, :])
        a, b = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(a):
            continue
        near, q, s = near[np.ix_(a, b)], q[a], s[b]
        # A link counts for the stored vector here only if its own visits do not find the query.
        _, one, two = index.cells(x[s])
        width = two.shape[1]
        back = one[:, own[q] // width] + two[:, own[q] % width] <= reach[s][:, None]
        found = near @ weight[s]
        more = (near & ~back.T).T @ weight[q]
        label_q, label_s = ids[q].copy(), ids[s].copy()
        far = np.iinfo(np.int64).max
        while True:
            down = np.minimum(label_s, np.where(near, label_q[:, None], far).min(0))
            over = np.minimum(label_q, np.where(near, down[None, :], far).min(1))
            if (down == label_s).all() and (over == label_q).all():
                break
            label_q, label_s = over, down
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids[q], ids[s]])), pa.array(np.concatenate([found, more])), pa.array(np.concatenate([label_q, label_s]))],
            ["id", "links", "root"],
        )


def near_vectors(embeddings: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links and component_id of each row of embeddings (vec_id, embedding).

    Two vectors of one length are linked if their cosine is at least the threshold; n_links counts all
    other linked rows, copies too. A component is all that links connect, named by its smallest
    vec_id. Vectors that are null, empty, zero or hold null or non-finite numbers, and rows without
    vec_id, are linked with nothing. Other columns are not read.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_units, "vec_id long, size int, digest binary, body binary")
    rows = stored(rows, "vectors")
    classes = rows.where("digest is not null").groupBy("size", "digest").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("body").alias("body"))
    classes = stored(classes, "classes")
    total = classes.count()
    drawn = classes.select("size", "body", "id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    if total == 0:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    sizes = drawn.column("size").to_numpy()
    common = int(np.bincount(sizes).argmax())
    drawn = drawn.filter(pa.array(sizes == common))
    sample = unit(drawn.column("body").to_pylist(), common)
    index = fit(sample, total)
    fit_visits(index, classes, sample, drawn.column("id").to_numpy(), threshold)
    dealt = classes.mapInArrow(lambda it: _dealt(it, index), "id long, size int, weight long, body binary, cell int, query boolean, own_cell int, reach double")
    dealt = stored(dealt, "cells")
    # Blocks of each cell; the grid has at most MOST_WORDS ** 2 cells of each vector length.
    blocks = dealt.groupBy("cell", "size").agg(
        F.ceil(F.count_if("query") / BLOCK).cast("int").alias("query_blocks"), F.ceil(F.count_if(~F.col("query")) / BLOCK).cast("int").alias("stored_blocks")
    )
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    placed = dealt.join(blocks.where("query_blocks > 0 and stored_blocks > 0"), ["cell", "size"])
    spread = placed.select(
        "cell", "size", "id", "weight", "body", "query", "own_cell", "reach",
        F.when(F.col("query"), F.array(own("query_blocks"))).otherwise(every("query_blocks")).alias("qs"),
        F.when(F.col("query"), every("stored_blocks")).otherwise(F.array(own("stored_blocks"))).alias("ss"),
    )
    keys = ["cell", "size", "query_block", "stored_block"]
    spread = spread.withColumn("query_block", F.explode("qs")).withColumn("stored_block", F.explode("ss")).drop("qs", "ss")
    links = spread.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda it: _linked(it, index, threshold), "id long, links long, root long")
    links = stored(links, "links")
    part = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")), "parts").withColumnRenamed("node", "id")
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.select("size", "digest", "id", "weight").join(counted, "id", "left").join(part, "id", "left")
    known = known.select("size", "digest", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return rows.select("vec_id", "size", "digest").join(known, ["size", "digest"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
