"""Benchmark passages in documents: a prefix-filtered set join in DataFrame operations only.

A window is the set of its tokens: runs of three words by 64-bit hash, of all its words if it has fewer. It must be
wholly contained in a document, so of its tokens ordered from rare to frequent, the one rarest is the necessary
prefix: a document without it cannot hold the window. Where a document has tokens of items is stored once; rarity
comes from there, and joined with the prefixes it tells the only places where a window can lie. There, and in these
documents only, the words are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecsink.llm.shared import id_filter, stored, with_maybe

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a token.
WIDTH = 3


def words_of(text: Column) -> Column:
    """Words of digits, letters and what is not ASCII, A-Z as a-z; none of null."""
    # Of a text of one byte per character lower() changes A-Z only, and is faster.
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BETWEEN), "")


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows of `size` words and the item each is from; a shorter item is one window."""
    worded = items.select("item_id", words_of(F.col("text").cast("string")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return worded.select("item_id", "w", F.explode(starts).alias("p")).select("item_id", F.slice("w", F.col("p"), F.lit(size)).alias("window")).distinct()


def _token(words: str, at: str, width: int) -> Column:
    """Hash of so many words from a place on; words that are not there count for nothing."""
    return F.xxhash64(*(F.get(words, F.col(at) + k) for k in range(width)))


def _window_tokens(windows: DataFrame) -> DataFrame:
    """number, size, at and token: each token of each window and its place there."""
    placed = windows.select("number", "window", F.size("window").alias("size"), F.posexplode("window").alias("at", "word"))
    width = F.least("size", F.lit(WIDTH))
    token = F.coalesce(*(F.when(width == k, _token("window", "at", k)) for k in range(1, WIDTH + 1)))
    return placed.where(F.col("at") + width <= F.col("size")).select("number", "size", "at", token.alias("token"))


def _matches(documents: DataFrame, vocabulary: DataFrame, widths: Sequence[int]) -> DataFrame:
    """row_id, n_words, p and token for each place of a document with a token of the vocabulary, and one row with `head` for each document."""
    spread = documents.select("row_id", "words", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("p", "word"))
    tokens = spread.select("row_id", "n_words", "p", _token("words", "p", widths[0]).alias("token"), F.lit(True).alias("one"))
    if len(widths) > 1:
        each = F.array(*(F.struct(_token("words", "p", k).alias("token"), F.lit(k == widths[0]).alias("one")) for k in widths))
        tokens = spread.select("row_id", "n_words", "p", F.explode(each).alias("x")).select("row_id", "n_words", "p", "x.*")
    tokens = tokens.withColumn("head", F.expr("one AND coalesce(p, 0) = 0")).drop("one")
    known = vocabulary.select("token", F.lit(True).alias("known"))
    return tokens.join(known, "token", "left").where("known OR head").select("row_id", "n_words", "p", "token", "head", F.coalesce("known", F.lit(False)).alias("known"))


def _prefixes(tokens: DataFrame, matches: DataFrame) -> DataFrame:
    """token, at and size: the rarest token of each window, its place there and the window's words."""
    counted = matches.where("known").groupBy("token").agg(F.count("*").alias("n"))
    ranked = tokens.join(counted, "token", "left").groupBy("number", "size")
    rarest = ranked.agg(F.min(F.struct("n", "token", "at")).alias("rare"), F.count("*").alias("of"), F.count("n").alias("found"))
    # A window with a token that no document has lies nowhere.
    return rarest.where("found = of").select("rare.token", "rare.at", "size").distinct()


def contaminated(documents: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """Documents with their words that lie in a window of an item, and the items.

    Returns doc_id, n_words, n_hit, n_items and item_ids (sorted as strings), one row for each row
    of documents. Windows are `size` consecutive words of an item; an item of fewer words is
    one window. Null or empty texts have no words, and items without words no windows. A row of items
    without item_id counts for its hits and not as an item. Other columns are not read.
    """
    text = F.col("text").cast("string")
    # Rows with one doc_id may hold different texts.
    row_id = F.struct("doc_id", F.xxhash64(text).alias("text")).alias("row_id")
    named = stored(item_windows(items, size), "named")
    # Stored tables have a size that Spark knows, by which it broadcasts them or shuffles both sides.
    windows = stored(named.select("window").distinct().withColumn("number", F.monotonically_increasing_id()), "windows")
    tokens = stored(_window_tokens(windows), "tokens")
    widths = [r.width for r in tokens.select(F.least("size", F.lit(WIDTH)).alias("width")).distinct().orderBy("width").collect()]
    vocabulary = stored(tokens.select("token").distinct(), "vocabulary")
    matches = stored(_matches(documents.select(row_id, words_of(text).alias("words")), vocabulary, widths or [WIDTH]), "matches")
    found = matches.where("known").join(stored(_prefixes(tokens, matches), "prefixes"), "token").where("p >= at AND p - at + size <= n_words")
    place = F.struct((F.col("p") - F.col("at")).alias("start"), "size")
    places = stored(found.groupBy("row_id").agg(F.collect_set(place).alias("places")), "places")
    held = with_maybe(documents.select(text.alias("text"), row_id), "row_id", id_filter(places, "row_id")).where("maybe")
    worded = held.join(places, "row_id").select("row_id", words_of(F.col("text")).alias("words"), "places")
    spans = worded.select("row_id", "words", F.explode("places").alias("x")).select("row_id", "x.*", F.slice("words", F.col("x.start") + 1, F.col("x.size")).alias("window"))
    hits = stored(spans.join(windows, "window").select("row_id", "start", "size", "number"), "hits")
    # Of each span the words that no span before it covers.
    before = F.max(F.col("start") + F.col("size")).over(Window.partitionBy("row_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("start") + F.col("size") - F.greatest("start", F.coalesce(before, F.lit(0)))
    n_hit = hits.select("row_id", F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy("row_id").agg(F.sum("fresh").alias("n_hit"))
    numbers = named.where("item_id is not null").join(windows, "window").select("number", F.col("item_id").cast("string").alias("item"))
    item_ids = hits.select("row_id", "number").distinct().join(numbers, "number").groupBy("row_id").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    every = matches.where("head").select("row_id", "n_words").join(n_hit.join(item_ids, "row_id", "left"), "row_id", "left")
    every = every.select("row_id.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    return every.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "item_ids")
