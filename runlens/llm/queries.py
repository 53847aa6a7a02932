"""The registered queries: each operator with production settings over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import (
    alignment,
    decontaminate,
    html,
    lines,
    lm,
    negatives,
    ngram_join,
    packing,
    quality,
    surrogates,
    token_files,
    tokens,
    topk,
)
from runlens.session import remove_at_end, scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

# In use, a secret of the user's; here any text does.
SURROGATE_KEY = "for the registered query"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(docs, SURROGATE_KEY)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), VOCABULARY)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.without_repeats(docs)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read(spark, sf_dir, "documents"), VOCABULARY)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    noisy = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(read(spark, sf_dir, "embeddings").withColumn("label", noisy))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(read(spark, sf_dir, "documents"), BYTE_VOCABULARY, path, end=2)
    remove_at_end(spark, path)
    return token_files.read(spark, path, ids=False)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_VOCABULARY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_exact_topk": op4_exact_topk,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_files": op12_token_files,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
