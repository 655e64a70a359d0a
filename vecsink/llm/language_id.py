"""Languages of texts by interpolated Kneser-Ney models of characters.

A text becomes letters in lower case, with one space for all between them. For each language the
4-grams of all its training texts are counted; contexts and the continuation counts of shorter grams follow from
them. Probabilities are interpolated with one discount an order down to a uniform share. A model
is a sorted array of gram codes for each order with log2 probabilities of all languages beside it;
a text gets the language of the lowest cross-entropy per character.

No gram is left out. Grams of three and four letters are dealt by their two middle letters (the first two of
three) into pieces, so that a gram's context, what it continues and what is read when it is unknown lie in
its piece. Tasks build the pieces, and load one at a time while they score. Only pairs and
single letters, whose number letters bound and not texts, are one table.

Rejection: a text whose cross-entropy is above nearly all of that language's own training
texts is marked as rejected. The temperature of the score has the least loss over them. Both come from
all training texts; where these are among the texts to tell, each text is scored once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecsink.llm.shared import slices, stored, text_column
from vecsink.llm.words import U64

ORDER = 4
#: Bytes of a model's piece, and of texts that are scored at once.
PIECE_BYTES, BUFFER_BYTES = 8 << 20, 8 << 20
#: Share of a language's training texts that lie above its limit.
REJECTED_SHARE = 0.001
TEMPERATURES = (0.5, 1.0, 2.0, 4.0, 8.0, 16.0)
#: Steps of a bit in which texts are counted to find where a limit lies, and parts of a loss in a sum.
_STEPS, _PARTS = 1 << 12, 1 << 20
_EDGE, _SPACE = 1, 32
_PAD = ORDER - 1


class Letters:
    """Symbols of texts: 16 bits for each letter, a space between words, edges before each text."""

    def __init__(self):
        self.kind = np.full(0x110000, -1, dtype=np.int8)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts, where each text's edges begin, and whether each text has a letter."""
        lowered = [text.lower() for text in texts]
        pad = "\x02" * _PAD
        code = np.frombuffer("".join(pad + text + " " for text in lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = self.kind[code]
        if (kind < 0).any():
            new = np.unique(code[kind < 0])
            self.kind[new] = [chr(c).isalpha() for c in new.tolist()]
            kind = self.kind[code]
        lengths = np.array([len(text) + _PAD + 1 for text in lowered], dtype=np.int64)
        begin = np.cumsum(lengths) - lengths
        edge = np.zeros(len(code), dtype=bool)
        for k in range(_PAD):
            edge[begin + k] = True
        letter = kind.astype(bool)
        symbol = np.where(letter, code & 0xFFFF, _SPACE).astype(np.uint32)
        symbol[edge] = _EDGE
        keep = letter | edge
        # A space stays after a letter.
        keep[1:] |= letter[:-1]
        place = np.cumsum(keep) - keep
        has = np.add.reduceat(letter, begin) > 0 if len(begin) else np.zeros(0, dtype=bool)
        return symbol[keep], place[begin], has


def grams(symbol: np.ndarray, size: int) -> np.ndarray:
    """Code of the gram that ends at each symbol, 16 bits for each of its symbols."""
    code = symbol.astype(U64)
    out = code.copy()
    for k in range(1, size):
        out[k:] |= code[:-k] << U64(16 * k)
    return out


def _sums(texts_at: np.ndarray, total: int) -> np.ndarray:
    """Number of scored symbols of each text."""
    return np.diff(np.append(texts_at, total)) - _PAD


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """4-grams of each language and their counts, once for each partition or million grams."""
    letters, held = Letters(), {}

    def flush(lang):
        codes, counts = (np.concatenate(x) for x in zip(*held.pop(lang), strict=True))
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        head = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        return codes[head], np.add.reduceat(counts, head)

    def row(lang, codes, counts):
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

    for batch in batches:
        texts = text_column(batch)
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for a, b in slices(texts):
            part = texts.slice(a, b - a).to_pylist()
            for lang in set(langs[a:b]):
                symbol, begin, has = letters.symbols([part[i] for i in np.flatnonzero(langs[a:b] == lang)])
                if not has.any():
                    continue
                code = np.sort(np.delete(grams(symbol, ORDER), (begin[:, None] + np.arange(_PAD)).ravel()))
                head = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                held.setdefault(lang, []).append((code[head], np.diff(np.append(head, len(code)))))
                if sum(len(x) for x, _ in held[lang]) > 1_000_000:
                    codes, counts = flush(lang)
                    if len(codes) > 500_000:
                        yield row(lang, codes, counts)
                    else:
                        held[lang] = [(codes, counts)]
    for lang in list(held):
        yield row(lang, *flush(lang))


@dataclass
class Model:
    """Languages, and for each order sorted gram codes with log2 probabilities (grams x languages).

    backoff has, for each order above 1, contexts and what is added when a gram after one is unknown.
    With pieces, the two longest orders are in them: broadcast arrays of what `_piece` gives.
    """

    langs: list[str]
    codes: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    unknown: np.ndarray
    limits: np.ndarray
    temperature: float = 1.0
    pieces: tuple = ()

    def whole(self, piece: int) -> Model:
        """The model with one of its pieces; the caller holds it, the broadcast does not."""
        if not self.pieces:
            return self
        held = self.pieces[piece]
        parts = pickle.loads(held.value)
        held.__dict__.pop("_value", None)
        joined = [[*mine, *more] for mine, more in zip((self.codes, self.logs, self.contexts, self.backoff), parts, strict=True)]
        return replace(self, codes=joined[0], logs=joined[1], contexts=joined[2], backoff=joined[3], pieces=())


def _grouped(keys: np.ndarray, *values: np.ndarray):
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[head], *(np.add.reduceat(v[order], head) if len(head) else v[:0] for v in values)


def _at(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def discount_of(once: int, twice: int) -> float:
    """Discount of an order by its numbers of grams counted once and twice."""
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.1


def _language(codes: np.ndarray, counts: np.ndarray, high: int = ORDER, low: int = 1, discounts: dict[int, float] | None = None):
    """For each order from high to low: gram codes, discounted shares, contexts and the share left to shorter grams."""
    levels = []
    for size in range(high, low - 1, -1):
        context = codes >> U64(16)
        names, total, types = _grouped(context, counts, np.ones(len(counts)))
        discount = discounts[size] if discounts else discount_of((counts == 1).sum(), (counts == 2).sum())
        at, _ = _at(names, context)
        levels.append((codes, (counts - discount) / total[at], names, discount * types / total))
        # Kneser-Ney: a shorter gram counts once for each symbol it follows.
        shorter = codes & U64((1 << (16 * (size - 1))) - 1)
        codes, counts = _grouped(shorter, np.ones(len(counts)))
    return levels


def _interpolated(levels: dict, langs: list[str], low: int, high: int, lower_codes: np.ndarray, lower: np.ndarray, unknown: np.ndarray):
    """Codes, log2 probabilities, contexts and backoffs of the orders low to high, and the highest order's probabilities.

    lower_codes and lower are the order below low; for order 1, lower is the uniform share.
    """
    width = len(langs)
    out = [], [], [], []
    for size in range(low, high + 1):
        level = high - size
        codes = np.unique(np.concatenate([levels[lang][level][0] for lang in langs]))
        contexts = np.unique(np.concatenate([levels[lang][level][2] for lang in langs]))
        left = np.ones((len(contexts), width))
        share = np.zeros((len(codes), width))
        for j, lang in enumerate(langs):
            own, value, names, rest = levels[lang][level]
            share[np.searchsorted(codes, own), j] = value
            left[np.searchsorted(contexts, names), j] = rest
        if size == 1:
            below = np.broadcast_to(lower, share.shape)
            unknown = left[0] * lower
        else:
            at, there = _at(lower_codes, codes & U64((1 << (16 * (size - 1))) - 1))
            below = np.where(there[:, None], lower[at], unknown)
        at, _ = _at(contexts, codes >> U64(16))
        value = share + left[at] * below
        for held, new in zip(out, (codes, np.log2(value).astype(np.float32), contexts, np.log2(left).astype(np.float32)), strict=True):
            held.append(new)
        lower_codes, lower = codes, value
    return out, lower, unknown


def build_model(tables: dict[str, tuple[np.ndarray, np.ndarray]], high: int = ORDER, discounts: dict | None = None) -> Model:
    """A model from the gram codes and counts of each language, for orders up to high."""
    return _built(tables, high, discounts)[0]


def _built(tables, high, discounts):
    """The model, and its highest order's probabilities before rounding."""
    langs = sorted(tables)
    levels = {}
    for lang in langs:
        codes, counts = tables[lang]
        order = np.argsort(codes)
        levels[lang] = _language(codes[order], counts[order].astype(np.float64), high, 1, discounts and discounts[lang])
    letters = max(2, len(np.unique(np.concatenate([levels[lang][-1][0] for lang in langs])))) + 1
    width = len(langs)
    arrays, top, unknown = _interpolated(levels, langs, 1, high, np.zeros(0, dtype=U64), np.full(width, 1.0 / letters), np.zeros(width))
    return Model(langs, *arrays, np.log2(unknown).astype(np.float32), np.full(width, np.inf)), top, unknown


def piece_of(codes: np.ndarray, pieces: int) -> np.ndarray:
    """The piece of each 4-gram."""
    return (codes >> U64(16) & U64(0xFFFFFFFF)) % U64(pieces)


def _piece(lang: np.ndarray, codes: np.ndarray, counts: np.ndarray, langs: list[str], discounts: dict, lower_codes: np.ndarray, lower: np.ndarray, unknown: np.ndarray):
    """Arrays of the orders 3 and 4 of one piece, from its 4-grams of all languages."""
    levels = {}
    for name in langs:
        mine = np.flatnonzero(lang == name)
        mine = mine[np.argsort(codes[mine])]
        levels[name] = _language(codes[mine], counts[mine].astype(np.float64), ORDER, ORDER - 1, discounts[name])
    return _interpolated(levels, langs, ORDER - 1, ORDER, lower_codes, lower, unknown)[0]


def _known(model: Model, code: np.ndarray, size: int = ORDER) -> np.ndarray:
    """log2 probabilities of grams, of shorter ones where the model does not hold them."""
    if size == 0:
        return np.broadcast_to(model.unknown, (len(code), len(model.langs)))
    cut = code & U64((1 << (16 * size)) - 1) if size < ORDER else code
    at, there = _at(model.codes[size - 1], cut)
    if len(model.codes[size - 1]):
        out = model.logs[size - 1][at].copy()
    else:
        out = np.zeros((len(cut), len(model.langs)), dtype=np.float32)
    missing = np.flatnonzero(~there)
    if len(missing):
        rest = _known(model, cut[missing], size - 1)
        if size > 1 and len(model.contexts[size - 1]):
            where, known = _at(model.contexts[size - 1], cut[missing] >> U64(16))
            rest = rest + np.where(known[:, None], model.backoff[size - 1][where], 0)
        out[missing] = rest
    return out


class Scorer:
    """Cross-entropies of texts under a model; distinct grams are looked up once, piece by piece."""

    def __init__(self, model: Model):
        self.model, self.letters = model, Letters()
        self.held = None, None

    def _piece(self, number: int) -> Model:
        if self.held[0] != number:
            self.held = None, None
            self.held = number, self.model.whole(number)
        return self.held[1]

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits for each symbol (texts x languages), and whether a text has a letter."""
        model = self.model
        width = len(model.langs)
        if not texts:
            return np.zeros((0, width)), np.zeros(0, dtype=bool)
        symbol, begin, has = self.letters.symbols(texts)
        code, back = np.unique(grams(symbol, ORDER), return_inverse=True)
        logs = np.empty((len(code), width), dtype=np.float32)
        pieces = max(1, len(model.pieces))
        own = piece_of(code, pieces)
        order = np.argsort(own, kind="stable")
        stops = np.searchsorted(own[order], np.arange(pieces + 1))
        for number in range(pieces):
            mine = order[stops[number] : stops[number + 1]]
            if len(mine):
                logs[mine] = _known(self._piece(number), code[mine])
        edge = (begin[:, None] + np.arange(_PAD)).ravel()
        total = np.empty((len(begin), width))
        for j in range(width):
            bits = logs[:, j].astype(np.float64)[back]
            bits[edge] = 0
            total[:, j] = np.add.reduceat(bits, begin)
        return -total / np.maximum(1, _sums(begin, len(symbol)))[:, None], has


def _softmax(bits: np.ndarray, temperature: float) -> np.ndarray:
    x = -bits * temperature
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(documents: DataFrame) -> Model | None:
    """A model of the languages that lang names; None if no text has one.

    Rows with a null lang or text are not learned from. All grams are in the model, and all texts are scored for its
    limits and temperature. The driver holds a piece at a time, pairs and single letters.
    """
    known = documents.where("lang is not null and text is not null").select("text", "lang")
    model = _counted_model(known)
    return model and _calibrated(model, stored(entropies(known, model), "entropies"))


def _counted_model(known: DataFrame) -> Model | None:
    """The model of all grams of the texts, without limits and temperature."""
    counts = known.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stored(counts, "grams")
    levels, ones = {ORDER: counts}, []
    for size in range(ORDER, 1, -1):
        # Kneser-Ney: a shorter gram counts once for each symbol it follows.
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (16 * (size - 1))) - 1).cast("long")).alias("gram")
        shorter = levels[size].select("lang", shorter).groupBy("lang", "gram").agg(F.count("*").alias("n"))
        levels[size - 1] = stored(shorter, "grams") if size > 2 else shorter
    for size, level in levels.items():
        ones.append(level.groupBy("lang").agg(F.count("*").alias("all"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).withColumn("size", F.lit(size)))
    numbers = [row for level in ones for row in level.collect()]
    if not numbers:
        return None
    langs = sorted({row["lang"] for row in numbers})
    discounts = {lang: {row["size"]: discount_of(row["once"], row["twice"]) for row in numbers if row["lang"] == lang} for lang in langs}
    pairs = levels[2].toArrow()
    lang, gram, n = pairs.column("lang").to_pandas().to_numpy(), pairs.column("gram").to_numpy().view(U64), pairs.column("n").to_numpy()
    model, lower, unknown = _built({name: (gram[lang == name], n[lang == name]) for name in langs}, 2, discounts)
    lower_codes = model.codes[-1]
    size = sum(row["all"] for row in numbers if row["size"] == ORDER) * (8 + 4 * len(langs))
    # Odd, so that both letters tell the piece.
    pieces = size // PIECE_BYTES | 1

    def build(table: pa.Table) -> pa.Table:
        name, code, n = table.column("lang").to_pandas().to_numpy(), table.column("gram").to_numpy().view(U64), table.column("n").to_numpy()
        arrays = _piece(name, code, n, langs, discounts, lower_codes, lower, unknown)
        return pa.table([table.column("piece")[:1], pa.array([pickle.dumps(arrays, protocol=5)], pa.binary())], ["piece", "body"])

    middle = F.shiftright("gram", 16).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    dealt = counts.withColumn("piece", F.pmod(middle, F.lit(pieces).cast("long")))
    built = stored(dealt.groupBy("piece").applyInArrow(build, "piece long, body binary"), "pieces")
    context = known.sparkSession.sparkContext
    empty = pickle.dumps(_piece(np.zeros(0, object), np.zeros(0, U64), np.zeros(0), langs, discounts, lower_codes, lower, unknown), protocol=5)
    bodies = {row["piece"]: context.broadcast(bytes(row["body"])) for row in built.toLocalIterator()}
    rest = context.broadcast(empty)
    model.pieces = tuple(bodies.get(k, rest) for k in range(pieces))
    return model


def _calibrated(model: Model, scored: DataFrame) -> Model:
    """The model with the limits and the temperature of all rows that have a lang and a letter.

    A limit is the exact quantile, between the two values around its place. Counts in steps tell in
    which steps these lie, and only texts there are sorted. Losses are added as whole numbers, in any order.
    """
    place = F.array_position(F.array(*map(F.lit, model.langs)), F.col("lang")).cast("int")
    learned = scored.where("lang is not null and has_letter").select("lang", "bits", F.element_at("bits", place).alias("own"))
    learned = learned.withColumn("step", F.floor(F.col("own") * _STEPS))
    up = Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = learned.groupBy("lang", "step").agg(F.count("*").alias("n")).withColumn("below", F.sum("n").over(up) - F.col("n"))
    steps = steps.withColumn("at", (F.sum("n").over(Window.partitionBy("lang")) - 1) * F.lit(1 - REJECTED_SHARE))
    low, high = F.floor("at"), F.ceil("at")
    near = steps.where((F.col("below") <= high) & (F.col("below") + F.col("n") > low)).select("lang", "step", "below", "at")
    values = learned.select("lang", "step", "own").join(near, ["lang", "step"]).groupBy("lang", "step", "below", "at", "own").agg(F.count("*").alias("n"))
    up = Window.partitionBy("lang", "step").orderBy("own").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("stop", F.col("below") + F.sum("n").over(up))
    values = values.where((F.col("stop") > low) & (F.col("stop") - F.col("n") <= high))
    limits = values.groupBy("lang").agg(F.min("own").alias("low"), F.max("own").alias("high"), F.first(F.col("at") - low).alias("part")).collect()
    for row in limits:
        model.limits[model.langs.index(row["lang"])] = row["low"] + row["part"] * (row["high"] - row["low"])

    def loss(t: float) -> Column:
        others = F.aggregate("bits", F.lit(0.0), lambda total, bits: total + F.exp(F.lit(t) * (F.col("own") - bits)))
        return F.sum(F.round(F.least(F.ln(others), F.lit(-np.log(1e-12).item())) * _PARTS).cast("decimal(20, 0)"))

    losses = learned.agg(*(loss(t).alias(f"t{k}") for k, t in enumerate(TEMPERATURES))).first()
    if limits:
        model.temperature = min(zip(losses, TEMPERATURES, strict=True))[1]
    return model


def entropies(documents: DataFrame, model: Model) -> DataFrame:
    """The documents' columns but text, bits for each language, and has_letter."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = text_column(batch)
            rest = batch.select([c for c in batch.schema.names if c != "text"])
            for a, b in slices(texts, BUFFER_BYTES):
                bits, has = scorer.entropies(texts.slice(a, b - a).to_pylist())
                part = rest.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(bits), pa.list_(pa.float64())), pa.array(has)], [*part.schema.names, "bits", "has_letter"])

    schema = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes if n != "text")
    return documents.mapInArrow(score, f"{schema}, bits array<double>, has_letter boolean")


def _told(scored: DataFrame, model: Model) -> DataFrame:
    """What `identify` returns, from the bits of each text."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = np.array([*model.langs, "und"], dtype=object)
        for batch in batches:
            has = batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
            bits = batch.column("bits").flatten().to_numpy().reshape(len(has), len(model.langs))
            best = bits.argmin(axis=1)
            row = np.arange(len(has))
            low = bits[row, best]
            score = np.where(has, _softmax(bits, model.temperature)[row, best], 0.0)
            pred = langs[np.where(has, best, len(langs) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(low, mask=~has), pa.array(~has | (low > model.limits[best]))],
                ["doc_id", "lang_pred", "score", "bits", "rejected"],
            )

    kind = dict(scored.dtypes)["doc_id"]
    return scored.select("doc_id", "bits", "has_letter").mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double, bits double, rejected boolean")


def _untold(documents: DataFrame) -> DataFrame:
    """What `identify` returns if there is no model."""
    return documents.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"), F.lit(True).alias("rejected"))


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), bits (of the prediction, per character) and rejected.

    One row for each row of documents. A text that is null or has no letter is `und` with score
    0 and is rejected, as is every text if there is no model. The first language in sorted order wins a tie. Only text is read.
    """
    if model is None:
        return _untold(documents)
    return _told(entropies(documents.select("doc_id", F.col("text").cast("string").alias("text")), model), model)


def learn_and_identify(documents: DataFrame, learned: Column) -> DataFrame:
    """`identify` of all documents by `train` on the rows for which learned is true, with each text scored once.

    A row's lang tells nothing of its own scores but through the model, as in `train`.
    """
    lang = F.when(learned & F.col("text").isNotNull(), F.col("lang")).alias("lang")
    narrow = documents.select("doc_id", F.col("text").cast("string").alias("text"), lang)
    model = _counted_model(narrow.where("lang is not null").select("text", "lang"))
    if model is None:
        return _untold(narrow)
    scored = stored(entropies(narrow, model), "entropies")
    return _told(scored, _calibrated(model, scored))
