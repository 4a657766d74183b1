"""Checks of result files as relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinloom.functions import text as T

#: Order of the findings of a file.
CHECKS = ("duplicate_rows", "repeated_ids", "self_matches", "wrong_prefix", "unknown_ids", "missing", "extra")


def items(rows: DataFrame) -> DataFrame:
    """``s1, id`` per entry of the list column ``ids`` of ``rows(s1, ids)``."""
    return rows.select("s1", F.explode(T.decode_ids("ids")).alias("id"))


def duplicate_rows(rows: DataFrame) -> DataFrame:
    return rows.groupBy("s1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("s1").alias("offender"))


def repeated_ids(rows: DataFrame) -> DataFrame:
    ids = T.decode_ids("ids")
    return rows.where(F.size(ids) != F.size(F.array_distinct(ids))).select(F.col("s1").alias("offender")).distinct()


def self_matches(rows: DataFrame) -> DataFrame:
    return items(rows).where(F.col("id").startswith("S1-")).select(F.col("id").alias("offender")).distinct()


def _is_target():
    return F.col("id").startswith("S2-") | F.col("id").startswith("S3-")


def wrong_prefix(rows: DataFrame) -> DataFrame:
    return items(rows).where(~F.col("id").startswith("S1-") & ~_is_target()).select(F.col("id").alias("offender")).distinct()


def unknown_ids(rows: DataFrame, valid: DataFrame) -> DataFrame:
    return items(rows).where(_is_target()).select("id").distinct().join(valid.select("id"), "id", "left_anti").select(F.col("id").alias("offender"))


def missing(rows: DataFrame, required: DataFrame) -> DataFrame:
    return required.select("s1").distinct().join(rows.select("s1"), "s1", "left_anti").select(F.col("s1").alias("offender"))


def extra(rows: DataFrame, required: DataFrame) -> DataFrame:
    return rows.select("s1").distinct().join(required.select("s1"), "s1", "left_anti").select(F.col("s1").alias("offender"))


def offenders(rows: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """``ord, check, offender`` of every rule that ``rows`` breaks."""
    found = {
        "duplicate_rows": duplicate_rows(rows),
        "repeated_ids": repeated_ids(rows),
        "self_matches": self_matches(rows),
        "wrong_prefix": wrong_prefix(rows),
        "missing": missing(rows, required),
        "extra": extra(rows, required),
    }
    if valid is not None:
        found["unknown_ids"] = unknown_ids(rows, valid)
    return reduce(DataFrame.unionByName, (df.select(F.lit(CHECKS.index(k)).alias("ord"), F.lit(k).alias("check"), "offender") for k, df in found.items()))


def _head(n: str, shown: str):
    """Five examples, with the total where there are more."""
    return F.when(F.col(n) > 5, F.concat(F.col(n).cast("string"), F.lit(" total, e.g. "), F.col(shown), F.lit(", ..."))).otherwise(F.col(shown))


def findings(rows: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """``ord, check, n, examples``: broken rules alone. Five examples by rank, so no
    list of all offenders is ever built."""
    found = offenders(rows, required, valid)
    totals = found.groupBy("ord", "check").agg(F.count(F.lit(1)).alias("n"))
    first = found.withColumn("r", F.row_number().over(Window.partitionBy("ord").orderBy("offender"))).where("r <= 5")
    shown = first.groupBy("ord").agg(F.concat_ws(", ", F.sort_array(F.collect_list("offender"))).alias("head"))
    return totals.join(shown, "ord").select("ord", "check", "n", _head("n", "head").alias("examples"))


def shown(found: DataFrame, place: int, severity: str, file: str, check: str) -> DataFrame:
    """One finding on distinct ``offender``s with examples by rank; no row where there are none."""
    total = found.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    first = found.orderBy("offender").limit(5).agg(F.concat_ws(", ", F.transform(F.sort_array(F.collect_list("offender")), lambda x: F.trim(x))).alias("head"))
    return total.join(first, F.lit(True)).select(F.lit(place).alias("place"), F.lit(severity).alias("severity"), F.lit(file).alias("file"), F.lit(check).alias("check"), "n", _head("n", "head").alias("examples"))


def file_summary(rows: DataFrame) -> DataFrame:
    empty = F.size(T.decode_ids("ids")) == 0
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(empty).alias("empties"), F.count_if(~empty).alias("non_empties"))


def outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """S1 ids with a match that is not among their candidates (a warning)."""
    return items(matches).distinct().join(items(candidates).distinct(), ["s1", "id"], "left_anti").select(F.col("s1").alias("offender")).distinct()


def last_rows(rows: DataFrame, order: str) -> DataFrame:
    """Of repeated S1 rows the last by ``order``, which is what later checks see."""
    latest = Window.partitionBy("s1").orderBy(F.col(order).desc())
    return rows.withColumn("_r", F.row_number().over(latest)).where("_r = 1").drop("_r")


def summary(truth: DataFrame, ids: str) -> DataFrame:
    """``total, matched, singletons`` of a list column, null or blank is single."""
    single = T.strip_space(ids) == ""
    return truth.agg(F.count(F.lit(1)).alias("total"), F.count_if(~single).alias("matched"), F.count_if(single).alias("singletons"))


def simple_check(rows: DataFrame, id_column: str, list_column: str) -> DataFrame:
    """``columns_ok, duplicates, total, empty, non_empty``; a null id is a value."""
    if set(rows.columns) != {id_column, list_column}:
        return rows.sparkSession.range(1).select(F.lit(False).alias("columns_ok"), *(F.lit(None).cast("long").alias(c) for c in ("duplicates", "total", "empty", "non_empty")))
    empty = T.strip_space(list_column) == ""
    per_id = rows.groupBy(id_column).agg(F.count(F.lit(1)).alias("n"), F.count_if(empty).alias("e"))
    return per_id.agg(F.lit(True).alias("columns_ok"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum("e"), F.lit(0)).alias("empty"), F.coalesce(F.sum(F.col("n") - F.col("e")), F.lit(0)).alias("non_empty"))


def output_check(lines: DataFrame) -> DataFrame:
    """One row on header-less output lines (``value``): totals and prefixes."""
    parts = F.split("value", "\t")
    rows = lines.select(F.size(parts).alias("n"), F.get(parts, F.lit(0)).alias("s1"), F.get(parts, F.lit(1)).alias("ids"))
    two = F.col("n") == 2
    bad = F.exists(F.when(F.col("ids") == "", F.array().cast("array<string>")).otherwise(F.split("ids", ",")), lambda x: ~(x.startswith("S2-") | x.startswith("S3-")))
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(two & F.col("s1").startswith("S1-")).alias("s1_ok"),
        F.count_if(two & (F.col("ids") == "")).alias("empty"),
        F.coalesce(F.bool_and(F.when(two, ~bad)), F.lit(True)).alias("s23_only"),
        F.count_if(~two).alias("bad_col"),
        F.count_if(two & ~F.col("s1").startswith("S1-")).alias("bad_prefix"),
    )


def output_examples(lines: DataFrame, most: int = 5) -> DataFrame:
    """``kind, line, example`` by line: the first wrong ids, and the first wrong candidate of the first such rows."""
    parts = F.split("value", "\t")
    rows = lines.select("line", F.size(parts).alias("n"), F.get(parts, F.lit(0)).alias("s1"), F.get(parts, F.lit(1)).alias("ids")).where("n = 2")
    ids = F.when(F.col("ids") == "", F.array().cast("array<string>")).otherwise(F.split("ids", ","))
    wrong = F.get(F.filter(ids, lambda x: ~(x.startswith("S2-") | x.startswith("S3-"))), F.lit(0))
    first = lambda df, kind, value: df.orderBy("line").limit(most).select(F.lit(kind).alias("kind"), "line", value.alias("example"))
    return first(rows.where(~F.col("s1").startswith("S1-")), "prefix", F.col("s1")).unionByName(first(rows.withColumn("w", wrong).where("w is not null"), "candidate", F.col("w")))
