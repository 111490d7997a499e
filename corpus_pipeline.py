"""Corpus pipeline: language, near duplicates, benchmark leaks, secrets, packing; each stage written and read again.

Every stage works on all rows that the one before it kept and returns the columns of `documents`, but for the last, which returns the
places of the pieces. Nulls, empty texts, ties, repeated rows and further columns are handled as each operator states.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import held_out
from meterlake.llm.jaccard import NO_ID, Link, first_of_groups
from meterlake.llm.language import identify, train
from meterlake.llm.leaks import find_leaks
from meterlake.llm.packing import pack_documents
from meterlake.llm.secret_scan import redact_documents
from meterlake.plans.session import checkpoint_folder

#: Near duplicates share 0.8 of their five-word shingles.
NEAR = Link(words=5, num=80, den=100)


def carried(docs: DataFrame, *names: str) -> DataFrame:
    """The columns that a stage works on, and whole rows beside them, so that no further column can clash."""
    return docs.select(F.struct(*docs.columns).alias("_row"), *names)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that no learned language takes: without a letter, or too far from the nearest language."""
    model = train(docs, ~held_out(F.col("doc_id")))
    return identify(carried(docs, "text"), model).filter(~F.col("rejected")).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of every group of near duplicates the row with the smallest id (rows without one come last); of repeated rows one.

    Rows are told apart by id and text, so rows without an id, or with the same one, are kept or go each on its own. Texts without a word
    are no duplicates and stay, however often they occur.
    """
    kept = first_of_groups(docs.select("doc_id", "text"), NEAR).select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"))
    text = F.coalesce("text", F.lit(""))
    rows = carried(docs, "text").withColumn("_id", F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(NO_ID))).withColumn("_sha", F.unhex(F.sha2(text, 256)))
    rows = rows.join(kept, ["_id", "_sha"], "left_semi")
    copies = Window.partitionBy("_id", "_sha").orderBy(F.lit(0))
    blank = F.trim(text) == ""
    return rows.withColumn("_copy", F.row_number().over(copies)).filter((F.col("_copy") == 1) | blank).select("_row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, edited copies included."""
    found = find_leaks(carried(docs, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size("leaks") == 0).select("_row.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret; n_chars follows the text where there is such a column."""
    masked = redact_documents(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]
#: Models, shingle sets, alignments and tokenizers are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each result is a table in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
