"""Queries of the operators that read whole texts in Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.catalog.registry import table
from jobstrata.llm import (
    decontaminate,
    jaccard_join,
    ordinal_quality,
    repeated_windows,
    suffix_dedup,
    token_files,
    toxicity,
)
from jobstrata.llm.registry import corpus_query
from jobstrata.llm.samples import fold_of
from jobstrata.llm.storage import shared_folder


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@corpus_query()
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(docs, folder, tokenizer_path())
    return token_files.read_token_files(manifest, folder)


@corpus_query()
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scanned(docs, table(spark, sf_dir, "benchmark")).drop("text")
    return decontaminate.judged(found).select(
        "doc_id",
        F.col("hit_words").alias("n_words"),
        "n_hit",
        F.coalesce(F.size("hit_items"), F.lit(0)).cast("long").alias("n_items"),
        "items_sha256",
        "contaminated",
    )


@corpus_query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, lexicon).select(
        "doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score", "predicted", "n_hits"
    )


def graded_labels(labels: DataFrame) -> DataFrame:
    """Three grades from the two labels: 0 low quality, 1 good but toxic, 2 good and clean."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.dropna(subset=["quality", "toxic"]).select("doc_id", grade.alias("grade"))


@corpus_query()
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = graded_labels(table(spark, sf_dir, "labels"))
    model = ordinal_quality.fitted(docs, ratings, "grade", 3)
    return ordinal_quality.graded(docs, model).select(
        "doc_id",
        (fold_of("doc_id") == 0).alias("held_out"),
        "expected_grade",
        "tail_probability",
        "kept",
    )


@corpus_query()
def op3_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return repeated_windows.without_repeated_windows(docs).drop("kept_text")


@corpus_query()
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_dedup.without_repeated_bytes(docs).drop("kept_bytes")


@corpus_query()
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))
