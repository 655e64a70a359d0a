"""A training corpus from documents: toxic texts, near copies, repeats and benchmarks out, the rest packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecsink.llm import toxicity
from vecsink.llm.decontamination import contaminated
from vecsink.llm.minhash_dedup import near_copies
from vecsink.llm.packing import pack
from vecsink.llm.queries import TOXIC_SCORE, table, tokenizer_file
from vecsink.llm.shared import stored, without
from vecsink.llm.substring_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of all labels does not take for toxic."""
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_SCORE).drop("score")


def minhash_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (80 percent of 5-word shingles) the smallest doc_id. Rows of one doc_id stay together."""
    docs = docs.select(*COLUMNS)
    found = near_copies(docs)
    return without(docs, "doc_id", stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "copies"))


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 13 words that a smaller doc_id holds; texts that lose nothing stay as they are."""
    kept = remove_repeats(docs.select(*COLUMNS), columns=("lang", "source"), whole=True)
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of 10 words of a benchmark item."""
    docs = docs.select(*COLUMNS)
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, "doc_id", stored(found.where("n_hit > 0").select("doc_id").distinct(), "leaks"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    pieces = pack(docs, tokenizer_file("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity_filter),
    ("minhash near-dedup", minhash_filter),
    ("substring dedup", substring_removal),
    ("benchmark decontamination", benchmark_filter),
    ("packing", packing),
]

#: A trained classifier and a tokenizer cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
