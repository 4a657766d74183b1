"""Whole runs: candidate generation and the aligned sample."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.functions import text as T
from kinloom.operators import blocking as B
from kinloom.storage import settle


@dataclass(frozen=True)
class Settings:
    max_bucket: int = B.MAX_BUCKET
    city_cap: int = B.CITY_CAP
    stop_sample: int = B.STOP_SAMPLE
    stop_threshold: int = B.STOP_THRESHOLD
    limit: int = 0


def blocking_run(reference: DataFrame, others: DataFrame, row: str, settings: Settings = Settings()) -> DataFrame:
    """Candidate lists of ``reference`` (ordered by ``row``) in ``others`` (with ``src`` 2 or 3)."""
    stops = B.stop_words(reference, row, settings.stop_sample, settings.stop_threshold)
    index = B.capped_index(settle(B.index_entries(others, stops), "index"), settings.max_bucket, settings.city_cap)
    asked = B.first_rows(reference, settings.limit, row)
    pairs = B.candidate_pairs(asked, index, stops, row, "entity_id")
    return B.candidate_lists(asked, pairs, row)


@dataclass(frozen=True)
class Aligned:
    truth: DataFrame
    reference: DataFrame
    second: DataFrame
    third: DataFrame


def aligned_sample(truth: DataFrame, reference: DataFrame, second: DataFrame, third: DataFrame, row: str, n: int = 2000) -> Aligned:
    """The first ``n`` matched truth rows by ``row``, and all records that they name."""
    chosen = B.first_rows(truth.where(T.strip_space("matched_entity_ids") != ""), n, row)
    ids = chosen.select(F.col("source1_entity_id").alias("entity_id")).distinct()
    matched = chosen.select(F.explode(F.split("matched_entity_ids", ",")).alias("entity_id")).distinct()
    return Aligned(chosen, reference.join(ids, "entity_id", "left_semi"), second.join(matched, "entity_id", "left_semi"), third.join(matched, "entity_id", "left_semi"))
