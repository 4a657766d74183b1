"""Whole runs from files to files: candidate generation and validation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.operators import blocking as B
from kinloom.plans import validate as V
from kinloom.plans.run import Settings
from kinloom.sources import tsv
from kinloom.storage import settle

FINDING = "place int, severity string, file string, check string, n long, examples string"


@dataclass(frozen=True)
class RunReport:
    """Counters of a run; ``stops`` are the first twenty frequent words."""

    rows: int
    candidates: int
    mean: float
    most: int
    errors: int
    indexed: dict[str, int]
    keys: dict[str, int]
    n_stops: int
    stops: list[str]

    def lines(self) -> list[str]:
        return [
            f"frequent words: {self.n_stops} ({', '.join(self.stops)})",
            *(f"records indexed from {k}: {v}" for k, v in self.indexed.items()),
            *(f"{k}: {v}" for k, v in self.keys.items()),
            f"rows written: {self.rows}, without id: {self.errors}",
            f"candidates: {self.candidates}, mean {self.mean:.2f}, most {self.most}",
        ]


def run_blocking(spark: SparkSession, s1: str, s2: str, s3: str, out: str, *, header: bool = True, settings: Settings = Settings()) -> RunReport:
    """Candidate lists of source 1 among sources 2 and 3, a row per row of source 1 with an id.

    Rows follow the order of source 1. Index and lists are written once to the shared
    folder and read from there by the counters and the sink.
    """
    reference = settle(tsv.read_records(spark, s1, numbered=True), "reference")
    others = reduce(DataFrame.unionByName, (tsv.read_records(spark, p).withColumn("src", F.lit(i)) for i, p in ((2, s2), (3, s3))))
    stops = B.stop_words(reference, "line", settings.stop_sample, settings.stop_threshold)
    entries = settle(B.index_entries(others, stops), "index")
    sizes = settle(B.bucket_sizes(entries), "sizes")
    index = B.capped_index(entries, settings.max_bucket, settings.city_cap, sizes)
    asked = B.first_rows(reference, settings.limit, "line")
    lists = settle(B.candidate_lists(asked, B.candidate_pairs(asked, index, stops, "line", "entity_id"), "line"), "lists")
    tsv.write_lists(lists.orderBy("line"), out, header)
    stats = B.run_stats(asked, lists).first()
    held = {f"source {r.src}": r.n for r in tsv.index_records(others).groupBy("src").agg(F.count(F.lit(1)).alias("n")).collect()}
    keys = B.dropped_keys(sizes, settings.max_bucket).first().asDict()
    return RunReport(stats.rows, stats.candidates, stats["mean"], stats.most, stats.errors, dict(sorted(held.items())), keys, len(stops), stops[:20])


def _notes(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, FINDING)


def _file_findings(spark: SparkSession, path: str, label: str, header: tuple[str, ...], required: DataFrame, valid: DataFrame | None, place: int) -> tuple[DataFrame | None, DataFrame]:
    """Rows of a result file (None where it cannot be read) and its findings."""
    rows, fatal, bad = tsv.read_id_lists(spark, path, header)
    if rows is None:
        return None, _notes(spark, [(place, "error", label, "unreadable", 1, fatal[0])])
    undecoded = V.shown(tsv.invalid_lines(spark, path).select(F.sha1("value").alias("offender")), place, "error", label, "not_utf8")
    broken = V.findings(rows, required, valid).select((F.col("ord") + place + 2).alias("place"), F.lit("error").alias("severity"), F.lit(label).alias("file"), "check", "n", "examples")
    malformed = V.shown(bad.select(F.lpad(F.col("line").cast("string"), 12, " ").alias("offender")), place + 1, "error", label, "malformed_lines")
    return rows, undecoded.unionByName(malformed).unionByName(broken)


def validate(spark: SparkSession, matching: str, candidate: str | None, test_dir: str, check_ids: bool = True) -> DataFrame:
    """``place, severity, file, check, n, examples``: what is wrong with result files.

    A run passes if no row is an error. Source 1 of ``test_dir`` says which ids are wanted,
    and with ``check_ids`` sources 2 and 3 which exist. All rules are anti joins or aggregates
    that spill; five examples each, so a file in which every row is wrong costs no more.
    """
    wanted = f"{test_dir}/test_source1.tsv"
    if not tsv.exists(spark, wanted):
        return _notes(spark, [(0, "error", "sources", "no_reference", 1, wanted)])
    required = settle(tsv.read_ids(spark, wanted), "required")
    out, valid = [], None
    if check_ids:
        valid, warning = tsv.read_targets(spark, test_dir)
        if warning:
            out.append(_notes(spark, [(1, "warning", "sources", "ids_not_checked", 1, warning)]))
        else:
            valid = settle(valid, "valid")
    else:
        out.append(_notes(spark, [(1, "warning", "sources", "ids_not_checked", 1, "left out on request")]))
    matched, found = _file_findings(spark, matching, "matching", tsv.MATCH_HEADER, required, valid, 10)
    out.append(found)
    if candidate is None or not tsv.exists(spark, candidate):
        out.append(_notes(spark, [(30, "warning", "candidates", "no_candidates", 1, candidate or "no file named")]))
    else:
        listed, found = _file_findings(spark, candidate, "candidates", tsv.CANDIDATE_HEADER, required, valid, 30)
        out.append(found)
        if matched is not None and listed is not None:
            outside = V.outside_candidates(V.last_rows(matched, "line"), V.last_rows(listed, "line"))
            out.append(V.shown(outside, 50, "warning", "matching", "outside_candidates"))
    return reduce(DataFrame.unionByName, out)


def passed(findings: DataFrame) -> bool:
    return findings.where("severity = 'error'").isEmpty()
