"""A training corpus from the table of documents, in five stages.

Each stage is written as Parquet to the shared folder and read again as the next one's documents.
All but the last return the columns of ``documents``; the last one the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowguard.llm import decontamination, language_id, near_duplicates, packing, suffix_dedup
from rowguard.llm.common import table, written

#: Passages of so many bytes that an earlier document has too are cut out: less than 50 words.
REPEATED_BYTES = 100


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without text or letters go."""
    return language_id.with_language(docs)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return near_duplicates.without_near_duplicates(docs, width=5, percent=80)


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has too are cut out; a document of which nothing but white
    space is left goes. ``n_chars`` follows the text."""
    cut = suffix_dedup.without_repeats(docs, REPEATED_BYTES)
    left = (F.col("n_removed") == 0) | (F.trim("text") != "")
    kept = cut.filter(left)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, capacity=2048)


STAGES = [
    ("language ID", known_language),
    ("near-duplicates", no_near_duplicates),
    ("repeated passages", no_repeated_passages),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

#: SQL cannot express language identification or tokenizing; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
