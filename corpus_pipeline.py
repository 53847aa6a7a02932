"""A corpus pipeline over documents: quality, lines, near copies, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the
columns of documents. Each works on all that the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import decontaminate, lines, ngram_join, packing, quality
from runlens.llm.queries import VOCABULARY, read
from runlens.llm.shared import remove, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand earlier; a document that has lost all it had goes."""
    names = docs.columns
    left = lines.without_repeats(docs)
    left = left.where((F.col("n_removed") == 0) | (F.trim(F.regexp_replace("text", r"\s", "")) != ""))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", chars)
    return left.select(*(F.col(f"`{x}`") for x in names))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.without_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in a sequence."""
    return packing.pack(docs, VOCABULARY, sparing=True)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

# SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder once and read by the next.

    What a stage has read goes when it is written, so no more than two are there at a time.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            remove(spark, before)
        before = path
    return docs
