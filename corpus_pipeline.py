"""Corpus pipeline: documents through filters and into a mixture.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.llm import apportion, decontaminate, jaccard_join, quality_ratio, secret_ledger
from kinloom.llm.common import settle, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the likelihood ratio let through."""
    ratios = quality_ratio.fit_ratio(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")
    return quality_ratio.judge_quality(rows, ratios).where("kept").select("_row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: five words to a shingle, similarity 0.8.

    The least id of a group stays, a row without id only where no row of the group has
    one. Documents without words are in no group and stay.
    """
    return jaccard_join.without_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item, decided row by row."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_ledger.mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mixture takes."""
    return apportion.mix_sources(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("mixing sources to target weights", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, f"stage{k}")
    return docs


#: The stages rest on hashes, compression and alignment that SQL cannot express.
ORACLE_SQL = None
