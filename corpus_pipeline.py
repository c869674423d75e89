"""From raw documents to packed training sequences.

Each stage takes the documents its predecessor kept, as Parquet, and returns documents again;
the last returns packed pieces. Order: low quality goes, one text of each near-duplicate group
stays, benchmark text goes, personal data is replaced, and what is left is packed.

Columns other than ``doc_id``, ``text`` and ``n_chars`` pass through untouched. Empty tables give
empty results. A null text is an empty text to every stage; it scores the share of good labels,
links with nothing, and packs as the closing id alone.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import neighbours, odd_sketch, packing, pii, winnowing
from tidegate.llm.tables import crc_rest, read
from tidegate.session import run_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their labelled neighbours do not reject; learned as the query op10 learns."""
    model = neighbours.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").where(crc_rest("doc_id", 4) != 2))
    return neighbours.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return odd_sketch.first_of_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return winnowing.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = pii.redact_documents(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 1024 tokens."""
    return packing.packed_digest(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: Votes, sketches and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = run_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
