"""A corpus of documents, stage by stage: language, exact and near copies, benchmark passages, packing.

Each stage is a function (spark, docs, folder) -> DataFrame. Its result is written as Parquet and read again as
the next stage's documents; all but the last return the columns they got, of the rows they keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import decontamination, exact_dedup, language, near_dedup, packing
from tillstream.llm.base import table
from tillstream.llm.queries import tokenizer_path
from tillstream.plans.registry import Registry
from tillstream.session import tune, workspace

registry = Registry()


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is known; texts without a letter or with no language above chance go."""
    return language.accepted(docs, language.learnt_from(docs))


def no_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.without_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near duplicates the one with the smallest id."""
    return near_dedup.without_near_copies(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, folder, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("language", known_language),
    ("exact_dedup", no_copies),
    ("near_dedup", no_near_copies),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

# SQL has no kernel classifier, no shingle components and no tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


@registry.query(ORACLE_SQL, name="pipeline")
def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents."""
    root = workspace(tune(spark), "pipeline")
    docs = table(spark, folder, "documents")
    for number, (name, stage) in enumerate(STAGES):
        place = f"{root}/{number}-{name}"
        rows = stage(spark, docs, folder)
        rows.write.parquet(place)
        docs = spark.read.schema(rows.schema).parquet(place)
    return docs
