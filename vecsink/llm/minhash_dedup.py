"""Near copies among documents by MinHash with tensored banding.

A table key needs six minhash values to agree. Instead of drawing six for each table, two
collections of `parts` triples are drawn; table (i, j) takes triple i of the first and triple j
of the second. So parts ** 2 tables cost 6 * parts minhash values, about a square root of what
single tables would cost. With 10 parts (100 tables, 60 values) a pair of Jaccard similarity 0.8
meets in a table with probability 0.998, one of 0.85 with 0.9998, one of 0.9 with almost 1.

Documents with equal shingle sets are one class; only the smallest doc_id of each is hashed.
Within a bucket, documents gather around leaders: one whose sketch (two bits of each minhash
value) is too far from all leaders leads a group of its own. A pair of the least similarity
is that far with probability below 0.001. Members are then compared with their leader on full
shingle sets. Members of one bucket that are still in different components are compared with each
other, blocks against blocks, whichever leaders they follow; no member is left out and no pairs within a
component are formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.llm.components import components, joined_components
from vecsink.llm.shared import id_filter, slices, stored, text_column, with_maybe
from vecsink.llm.words import SPACED_LOWER, U64, constants, find_words, mix, text_of_each

PARTS = 10
WIDTH = 3
#: Members of a leader that are compared at once.
BLOCK = 2000
#: Bits of the filter of bucket keys, 4 MB at most; with more keys it lets more rows pass and the result stays the same.
TABLE_BITS = 1 << 25


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each text's begin."""
    words = find_words(texts, SPACED_LOWER)
    counts = words.count()
    text = text_of_each(words.first)
    n = len(words.hashes)
    with np.errstate(over="ignore"):
        factor = constants(size, 51) | U64(1)
        # A text of fewer words is one shingle: all its words, and how many.
        short = text[np.flatnonzero(counts[text] < size)] if n else text
        many = max(0, n - size + 1)
        value = np.zeros(many, dtype=U64)
        for k in range(size):
            value = mix(value + words.hashes[k : k + many] * factor[k])
        inside = np.flatnonzero(text[:many] == text[size - 1 :]) if many else np.zeros(0, dtype=np.int64)
        value, owner = value[inside], text[inside]
        few = np.unique(short)
        if len(few):
            whole = np.zeros(len(few), dtype=U64)
            for k in range(size - 1):
                has = counts[few] > k
                at = np.minimum(words.first[few] + k, n - 1)
                whole = np.where(has, mix(whole + words.hashes[at] * factor[k]), whole)
            value = np.concatenate([value, mix(whole ^ counts[few].astype(U64))])
            owner = np.concatenate([owner, few])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1), side="left")


def least_agreeing(parts: int, percent: int) -> int:
    """Minhash values that must seem equal: four deviations below what the least similarity gives."""
    free = 2 * (parts - 1) * WIDTH
    seem = percent / 100 + (1 - percent / 100) / 4
    return int(2 * WIDTH + free * seem - 4 * (free * seem * (1 - seem)) ** 0.5)


def _signed(batch: pa.RecordBatch, size: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Set size, a 128-bit name of the set, and the hashed triples of both collections."""
    texts, ids = text_column(batch), batch.column("doc_id")
    factors, shifts = constants(2 * parts * WIDTH, 61) | U64(1), constants(2 * parts * WIDTH, 62)
    for a, b in slices(texts):
        value, first = shingle_sets(texts.slice(a, b - a), size)
        counts = np.diff(first)
        full = np.flatnonzero(counts > 0)
        begin = first[:-1][full]
        rows = np.zeros((b - a, 2 * parts), dtype=U64)
        names, sketch = np.zeros((b - a, 2), dtype=U64), np.zeros((b - a, 2), dtype=U64)
        if len(full):
            with np.errstate(over="ignore"):
                for part in range(2 * parts):
                    joined = np.zeros(len(full), dtype=U64)
                    for k in range(part * WIDTH, part * WIDTH + WIDTH):
                        least = mix(np.minimum.reduceat(value * factors[k] + shifts[k], begin))
                        joined = mix(joined + least)
                        sketch[full, 0] |= (least & U64(1)) << U64(k)
                        sketch[full, 1] |= (least >> U64(1) & U64(1)) << U64(k)
                    rows[full, part] = joined
                names[full, 0] = np.add.reduceat(mix(value ^ constants(1, 63)[0]), begin)
                names[full, 1] = np.add.reduceat(mix(value ^ constants(1, 64)[0]), begin)
        flat = pa.array(rows.reshape(-1).view(np.int64))
        offsets = pa.array(np.arange(0, (b - a) * 2 * parts + 1, 2 * parts, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [ids.slice(a, b - a), pa.array(counts.astype(np.int64)), *(pa.array(x.view(np.int64)) for x in (*names.T.copy(), *sketch.T.copy())), pa.ListArray.from_arrays(offsets, flat)],
            ["doc_id", "n_shingles", "s1", "s2", "k1", "k2", "parts"],
        )


class Leaders:
    """Leaders of the buckets seen; rows come sorted by key, and a key may go on in the next batch."""

    def __init__(self, values: int, least: int):
        self.most = values - least
        self.last, self.count = None, 0
        self.led = [np.zeros(64, dtype=kind) for kind in (np.int64, U64, U64)]

    def _lead(self, doc, k1, k2, anew: bool = False) -> None:
        """Leaders of the present bucket, added in arrays that double."""
        start = 0 if anew else self.count
        self.count = start + len(doc)
        for i, values in enumerate((doc, k1, k2)):
            if self.count > len(self.led[i]):
                self.led[i] = np.concatenate([self.led[i], np.zeros(max(len(self.led[i]), self.count), dtype=self.led[i].dtype)])
            self.led[i][start : self.count] = values

    def near(self, a1, a2, b1, b2):
        return np.bitwise_count((a1 ^ b1) | (a2 ^ b2)) <= self.most

    def follow(self, key, doc, k1, k2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows that follow a leader, with the leader, and which rows lead."""
        n = len(key)
        leads = np.zeros(n, dtype=bool)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), leads
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        stop = np.append(begin[1:], n)
        rows, heads = [], []
        first = 0
        if key[0] == self.last:
            self._slowly(range(int(stop[0])), doc, k1, k2, leads, rows, heads)
            first = 1
        begin, stop = begin[first:], stop[first:]
        leads[begin] = True
        owner = np.repeat(begin, stop - begin)
        at = np.arange(int(begin[0]) if len(begin) else n, n)
        inner = at[owner != at]
        owner = owner[owner != at]
        good = self.near(k1[inner], k2[inner], k1[owner], k2[owner])
        rows.append(inner[good])
        heads.append(doc[owner[good]])
        far = inner[~good]
        far_owner = owner[~good]
        for head in np.unique(far_owner).tolist():
            self._lead(doc[[head]], k1[[head]], k2[[head]], anew=True)
            a, b = np.searchsorted(far_owner, [head, head + 1])
            self._slowly(far[a:b].tolist(), doc, k1, k2, leads, rows, heads)
        if len(begin):
            self.last = key[-1]
            at = np.flatnonzero(leads[begin[-1] :]) + begin[-1]
            self._lead(doc[at], k1[at], k2[at], anew=True)
        return np.concatenate(rows).astype(np.int64), np.concatenate(heads).astype(np.int64), leads

    def _slowly(self, at, doc, k1, k2, leads, rows, heads) -> None:
        """Rows one by one: each follows all leaders it is near to, or leads."""
        for i in at:
            d, a, b = (values[: self.count] for values in self.led)
            near = self.near(k1[i], k2[i], a, b)
            if near.any():
                heads.append(d[near & (d != doc[i])])
                rows.append(np.full(len(heads[-1]), i))
            else:
                leads[i] = True
                self._lead(doc[[i]], k1[[i]], k2[[i]])


def _keys(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket keys of a batch's rows in some tables at a time, and the row of each."""
    count = batch.num_rows
    values = batch.column("parts").flatten().to_numpy().view(U64).reshape(count, 2 * parts)
    for i in range(parts):
        with np.errstate(over="ignore"):
            tables = np.arange(i * parts, (i + 1) * parts, dtype=U64)
            key = mix(mix(values[:, i : i + 1] + constants(1, 81)[0]) ^ values[:, parts:] + tables * constants(1, 82)[0]).reshape(-1)
        yield key, np.repeat(np.arange(count), parts)


def _bucketed(batch: pa.RecordBatch, parts: int) -> Iterator[pa.RecordBatch]:
    """The bucket of each row in each table."""
    columns = ["doc_id", "component", "paired"]
    rest = batch.select(columns)
    for key, row in _keys(batch, parts):
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *rest.take(pa.array(row)).columns], ["leader", *columns])


def _tabled(batch: pa.RecordBatch, parts: int, percent: int) -> Iterator[pa.RecordBatch]:
    """A row for each table; those that follow a leader within the batch are linked, leaders are dealt."""
    ids, k1, k2 = (batch.column(c).to_numpy() for c in ("doc_id", "k1", "k2"))
    k1, k2 = k1.view(U64), k2.view(U64)
    for key, row in _keys(batch, parts):
        order = np.lexsort((ids[row], key))
        key, row = key[order], row[order]
        doc = ids[row]
        rows, heads, leads = Leaders(2 * parts * WIDTH, least_agreeing(parts, percent)).follow(key, doc, k1[row], k2[row])
        at = np.flatnonzero(leads)
        spread = mix(doc[rows].astype(U64))
        columns = [
            np.concatenate([key[at], spread]).view(np.int64),
            np.concatenate([doc[at], doc[rows]]),
            np.concatenate([k1[row[at]], k1[row[rows]]]).view(np.int64),
            np.concatenate([k2[row[at]], k2[row[rows]]]).view(np.int64),
            np.concatenate([np.zeros(len(at), dtype=np.int64), heads]),
        ]
        led = np.concatenate([np.zeros(len(at), bool), np.ones(len(rows), bool)])
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(led)], ["deal", "doc_id", "k1", "k2", "leader", "led"])


def _met(batches: Iterator[pa.RecordBatch], parts: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and doc_id, those that follow a leader."""
    leaders = Leaders(2 * parts * WIDTH, least_agreeing(parts, percent))
    for batch in batches:
        key, doc, k1, k2, leader = (batch.column(c).to_numpy() for c in ("deal", "doc_id", "k1", "k2", "leader"))
        led = batch.column("led").to_numpy(zero_copy_only=False)
        open_doc = doc[~led]
        rows, heads, _ = leaders.follow(key[~led], open_doc, k1[~led].view(U64), k2[~led].view(U64))
        a, b = np.concatenate([doc[led], open_doc[rows]]), np.concatenate([leader[led], heads])
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    texts, ids = text_column(batch), batch.column("doc_id")
    for a, b in slices(texts):
        value, first = shingle_sets(texts.slice(a, b - a), size)
        body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer((first * 8).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(value))])
        yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), body.cast(pa.binary())], ["doc_id", "body"])


def _similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have so much in common."""
    if min(len(one), len(two)) * 100 < percent * max(len(one), len(two)):
        return False
    at = np.searchsorted(one, two)
    common = int((one[np.minimum(at, len(one) - 1)] == two).sum())
    return 100 * common >= percent * (len(one) + len(two) - common)


def _agree(batch: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    """Pairs whose sets reach the similarity."""
    left, right = batch.column("left"), batch.column("right")
    keep = np.zeros(batch.num_rows, dtype=bool)
    for i in range(batch.num_rows):
        one, two = (np.frombuffer(x[i].as_buffer(), dtype=U64) for x in (left, right))
        keep[i] = _similar(one, two, percent)
    return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))


def _compared(batches: Iterator[pa.RecordBatch], parts: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links between components of one block pair; rows are sorted by block, strays first.

    Each stray is compared with the members of other components that its sketch is near to, until it
    is linked to their component.
    """
    leaders = Leaders(2 * parts * WIDTH, least_agreeing(parts, percent))
    block, strays, found = None, [], set()
    for batch in batches:
        names = list(zip(*(batch.column(c).to_pylist() for c in ("leader", "stray_block", "member_block")), strict=True))
        doc, component, k1, k2 = (batch.column(c).to_numpy() for c in ("doc_id", "component", "k1", "k2"))
        k1, k2 = k1.view(U64), k2.view(U64)
        stray, body = batch.column("stray").to_pylist(), batch.column("body")
        out = []
        for i, name in enumerate(names):
            if name != block:
                block, strays, found, sketches = name, [], set(), None
            one = np.frombuffer(body[i].as_buffer(), dtype=U64)
            if stray[i]:
                strays.append((int(doc[i]), int(component[i]), one, k1[i], k2[i]))
                continue
            if sketches is None:
                sketches = [np.array([x[k] for x in strays], dtype=U64) for k in (3, 4)]
            if not strays:
                continue
            for j in np.flatnonzero(leaders.near(sketches[0], sketches[1], k1[i], k2[i])).tolist():
                other, part, two = strays[j][:3]
                if part == component[i] or (other, int(component[i])) in found:
                    continue
                if _similar(one, two, percent):
                    found.add((other, int(component[i])))
                    out.append((max(other, int(doc[i])), min(other, int(doc[i]))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])


def _block_pairs(group: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of leaders whose members lie in several components, as blocks of strays and of all members.

    Strays are those outside a leader's main component.
    """
    sizes = group.groupBy("leader", "component").agg(F.count("*").alias("n"))
    split = sizes.groupBy("leader").agg(F.count("*").alias("components"), F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    split = split.where("components > 1").select("leader", "main", F.ceil(F.col("all") / BLOCK).cast("int").alias("member_blocks"), F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("stray_blocks"))
    mixed = group.join(split, "leader").join(sets, "doc_id")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["leader", "doc_id", "component", "k1", "k2", "body"]
    strays = mixed.where("component <> main").select(*columns, F.lit(True).alias("stray"), own("stray_blocks").alias("stray_block"), every("member_blocks").alias("member_block"))
    members = mixed.select(*columns, F.lit(False).alias("stray"), own("member_blocks").alias("member_block"), every("stray_blocks").alias("stray_block"))
    return strays.unionByName(members)


def _open_buckets(classes: DataFrame, pairs: DataFrame, part: DataFrame, parts: int) -> DataFrame:
    """Members (leader: the bucket, doc_id, component) of buckets whose members lie in several components.

    Two members of a bucket that were not compared are not both leaders, so one of them is in a pair, and a third
    member led it. So only buckets of documents in pairs matter: a filter of their keys is laid on the tables of all
    others as they are made. Buckets of the same members count once.
    """
    paired = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().withColumn("paired", F.lit(True))
    known = classes.select("doc_id", "parts").join(part.withColumnRenamed("node", "doc_id"), "doc_id", "left").join(paired, "doc_id", "left")
    known = stored(known.select("doc_id", "parts", F.coalesce("component", "doc_id").alias("component"), F.coalesce("paired", F.lit(False)).alias("paired")), "known")

    def tables(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(lambda it: (out for b in it for out in _bucketed(b, parts)), "leader long, doc_id long, component long, paired boolean")

    among = tables(known.where("paired"))
    others = with_maybe(tables(known.where("not paired")), "leader", id_filter(among.select("leader"), "leader", TABLE_BITS)).where("maybe").drop("maybe")
    members = stored(among.unionByName(others), "members")
    names = [F.bit_xor(F.xxhash64(F.lit(seed), "doc_id")).alias(f"h{seed}") for seed in (1, 2)]
    seen = members.groupBy("leader").agg(F.count("*").alias("n"), F.min("component").alias("least"), F.max("component").alias("most"), F.max("paired").alias("paired"), *names)
    split = seen.where("n > 2 AND least < most AND paired").groupBy("n", "h1", "h2").agg(F.min("leader").alias("leader")).select("leader")
    return stored(members.select("leader", "doc_id", "component").join(split, "leader", "left_semi"), "groups")


def near_copies(documents: DataFrame, size: int = 5, percent: int = 80, parts: int = PARTS) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of documents.

    Two documents are linked if percent of the union of their sets of `size`-word shingles is
    common to both; a component is all that links connect, named by its smallest doc_id. A text of
    fewer words is one shingle. A null text, or one without words, is linked with nothing. A row
    without doc_id has no component. Repeated rows are in one component. Other columns are not read.
    """
    if 2 * parts * WIDTH > 64:
        raise ValueError("a sketch has room for 64 minhash values")
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = narrow.mapInArrow(lambda it: (out for b in it for out in _signed(b, size, parts)), "doc_id long, n_shingles long, s1 long, s2 long, k1 long, k2 long, parts array<long>")
    signed = stored(signed, "signatures")
    named = ["n_shingles", "s1", "s2"]
    kept = F.min_by(F.struct("parts", "k1", "k2"), "doc_id").alias("kept")
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy(*named).agg(F.min("doc_id").alias("doc_id"), kept)
    # In many files, since each row becomes parts ** 2 rows.
    classes = stored(classes.select(*named, "doc_id", "kept.*").repartition(tasks, "doc_id"), "classes")
    tabled = classes.select("doc_id", "k1", "k2", "parts").mapInArrow(
        lambda it: (out for b in it for out in _tabled(b, parts, percent)), "deal long, doc_id long, k1 long, k2 long, leader long, led boolean"
    )
    pairs = tabled.repartition("deal").sortWithinPartitions("deal", "doc_id").mapInArrow(lambda it: _met(it, parts, percent), "a long, b long")
    pairs = stored(pairs.where("a <> b").distinct(), "pairs")
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")

    def sets_of(wanted: DataFrame) -> DataFrame:
        maybe = with_maybe(narrow.where("doc_id is not null"), "doc_id", id_filter(wanted, "doc_id")).where("maybe").select("doc_id", "text")
        sets = maybe.join(wanted, "doc_id", "left_semi").mapInArrow(lambda it: (out for b in it for out in _sets(b, size)), "doc_id long, body binary")
        return stored(sets.dropDuplicates(["doc_id"]), "sets")

    def compared(group: DataFrame, sets: DataFrame) -> DataFrame:
        blocks = _block_pairs(group, sets.join(classes.select("doc_id", "k1", "k2"), "doc_id"))
        dealt = blocks.repartition("leader", "stray_block", "member_block").sortWithinPartitions("leader", "stray_block", "member_block", F.desc("stray"))
        return stored(dealt.mapInArrow(lambda it: _compared(it, parts, percent), "a long, b long"), "links")

    sets = sets_of(wanted)
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("body").alias("left")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("body").alias("right")), "b")
    links = stored(both.select("a", "b", "left", "right").mapInArrow(lambda it: (_agree(b, percent) for b in it), "a long, b long"), "links")
    part = components(links, "parts")
    group = _open_buckets(classes, pairs, part, parts)
    missing = stored(group.select("doc_id").distinct().join(wanted, "doc_id", "left_anti"), "wanted")
    part = joined_components(part, compared(group, sets.union(sets_of(missing))), "parts")
    joined = classes.select(*named, "doc_id").join(part.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(*named, F.coalesce("component", "doc_id").alias("component"))
    found = signed.select("doc_id", *named).join(joined, named, "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
