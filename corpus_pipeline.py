"""The corpus pipeline: filter, dedup, decontaminate, mix, and write token files.

Each stage takes (spark, docs, sf_dir), with ``docs`` read from the Parquet table its
predecessor wrote, and returns the DataFrame to write. All but the last return the columns
of ``docs``. ``run`` writes the stages' tables below the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.catalog.registry import table
from jobstrata.llm import decontaminate, jaccard_join, mixing, token_files, toxicity
from jobstrata.llm.queries_native import BLOCK, TARGETS
from jobstrata.llm.queries_text import tokenizer_path
from jobstrata.llm.storage import shared_folder

#: the columns that name a row's place in the stored table
STORED = ("__file", "__row")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches one half go; the lexicon is learned from
    the labelled documents of this input outside the held-out fold."""
    lexicon = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, lexicon)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each linked group stays: five-word shingles,
    similarity of 0.8 or more."""
    return jaccard_join.one_of_each_group(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order of the mixed stream: the files in the order of
    their names and the rows in a file follow the time slots."""
    order = ("mix_slot", "mix_place", "doc_id")
    placed = mixing.mixed(docs, TARGETS, BLOCK)
    # rows without a slot (sources without a target) come last
    last = F.col("mix_slot").isNull()
    sorted_ = placed.repartitionByRange(last, *order).sortWithinPartitions(last, *order)
    return sorted_.select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents in stored order; per document its place and digest.

    Rows whose table has no files behind it (tests) are put in order of their id.
    """
    stored = docs
    order: tuple[str, ...] = ("doc_id",)
    if docs.inputFiles():
        stored = docs.select(
            "doc_id",
            "text",
            F.col("_metadata.file_name").alias(STORED[0]),
            F.col("_metadata.row_index").alias(STORED[1]),
        )
        order = STORED
    folder = shared_folder(spark, "pipeline-tokens")
    # the other stages' workers are the same ones, so little is kept in them
    manifest = token_files.write_token_files(
        stored,
        folder,
        tokenizer_path(),
        order=order,
        slice_bytes=2 << 20,
        keep_pieces=False,
        kept_bytes=8 << 20,
    )
    return token_files.read_token_files(manifest, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: tokens and learned weights are beyond SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole documents table, each written as Parquet and read again."""
    top = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{top}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
