"""Helpers that the text operators share."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.storage import scratch, settle, shared_dir

__all__ = ["SPACE", "WORD", "bind", "fold", "n_words", "row_key", "row_name", "scratch", "settle", "shared_dir", "ship", "table", "without_rows", "words_of"]

#: White space of every contract here: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per Spark context."""
    context = spark.sparkContext
    top = Path(__file__).resolve().parents[1]
    if getattr(context, "_kinloom_shipped", False) or not top.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="kinloom-")) / "kinloom-sources.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    context.addPyFile(str(path))
    context._kinloom_shipped = True


def bind(value: Column, body) -> Column:
    """``body(x)`` with ``value`` evaluated once, also inside nested lambdas.

    Catalyst inlines a projected column into the lambda that reads it and then
    evaluates it per element; a lambda variable cannot be inlined.
    """
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text as an array, empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """32 bytes that name a row by its id and whole text; ``row_name`` is the same in Python.

    Ids may be null or shared by different texts, so filters decide by this key.
    """
    told = F.concat(F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col(text).cast("string"), F.lit("")))
    return F.unhex(F.sha2(told.cast("binary"), 256))


def row_name(doc_id: int | None, text: bytes | None) -> bytes:
    return hashlib.sha256(f"{'-' if doc_id is None else doc_id}:".encode() + (text or b"")).digest()


def without_rows(rows: DataFrame, keys: DataFrame, most_broadcast: int = 500_000) -> DataFrame:
    """Rows of documents whose ``row_key`` is not in ``keys`` (``row``).

    The keys are counted first: up to ``most_broadcast`` (32 bytes each) are broadcast
    and the rows stay where they are, more are joined by a shuffle.
    """
    keys = settle(keys.select(F.col("row").alias("__row")).distinct(), "keys")
    side = F.broadcast(keys) if keys.count() <= most_broadcast else keys
    return rows.withColumn("__row", row_key()).join(side, "__row", "left_anti").select(*rows.columns)
