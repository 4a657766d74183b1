"""Quality rules with a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word 1- and 2-grams are counted: trusted documents
(labelled good) and the raw corpus (every document). A document's score is the
mean over its n-grams of ``ln((t + k) / (e + k))``, where ``t`` counts a bucket in
the trusted part, ``e`` is what the raw corpus would give that part, and ``k`` are
pseudo-counts. Ratios are held as whole numbers, so the sum and the verdict do not
depend on order, partitioning or machine.

All is done by built-in expressions within a row. Tables of ``2 ** bits`` numbers
are all that leaves a task when counting; scoring moves nothing.

Defined cases: a null or blank text has no words, all counts 0, score 0 and
fails the base rules; rows with equal ids are judged one by one; a null id is never trusted;
without trusted documents, and for an empty table, every ratio is 0; a null label is not trusted;
texts of any length are counted whole; columns whose names clash with the added ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import SPACE, bind, settle, words_of

SCALE = 1 << 20
BITS = 16
THRESHOLD = -0.12
PSEUDO = 5.0


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _buckets(hashes: Column, bits: int) -> Column:
    """Buckets of the 1-grams and 2-grams of an array of word hashes."""
    size = F.lit(1 << bits)
    one = F.transform(hashes, lambda h: F.pmod(h, size).cast("int"))
    n = F.greatest(F.size(hashes) - 1, F.lit(0))
    two = F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(2), n), lambda a, b: F.pmod(F.xxhash64(a, b), size).cast("int"))
    return F.concat(one, two)


def _covered(windows: Column, width: int) -> Column:
    """Word positions inside a window whose hash occurs at least twice.

    Sorted by hash, equal neighbours are repeats; sorted by place again, each
    adds what the one before it has not covered.
    """
    numbered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i"))))

    def places(rows: Column) -> Column:
        n = F.size(rows)
        same = lambda i, j: F.coalesce(F.get(rows, i).getField("h") == F.get(rows, j).getField("h"), F.lit(False))
        kept = F.filter(rows, lambda r, i: same(i, F.when(i > 0, i - 1)) | same(i, F.when(i < n - 1, i + 1)))
        return F.sort_array(F.transform(kept, lambda r: r.getField("i")))

    def total(at: Column) -> Column:
        gaps = F.zip_with(F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0))), F.slice(at, F.lit(1), F.greatest(F.size(at) - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(width)))
        return F.aggregate(gaps, F.lit(width).cast("long"), lambda s, g: s + g)

    return bind(numbered, lambda rows: bind(places(rows), total))


def _repeats(hashes: Column, width: int) -> Column:
    n = F.size(hashes) - width + 1
    windows = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(hashes, i, F.lit(width))))
    found = bind(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_covered(w, width)))
    return F.when(n < 2, F.lit(0).cast("long")).otherwise(found)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_good")).distinct()


def fit_ratio(docs: DataFrame, labels: DataFrame, *, bits: int = BITS, pseudo: float = PSEUDO, most_broadcast: int = 2_000_000) -> list[int]:
    """Scaled log ratios by bucket.

    The raw side counts all documents, the trusted side all that are labelled good. Their ids
    are counted: up to ``most_broadcast`` (8 bytes each) are broadcast, so no text moves,
    more are joined by a shuffle.
    """
    good = settle(trusted_ids(labels), "trusted")
    good = F.broadcast(good) if good.count() <= most_broadcast else good
    counts = (
        docs.select("doc_id", "text")
        .join(good, F.col("doc_id") == F.col("_good"), "left")
        .select(F.col("_good").isNotNull().cast("long").alias("t"), F.explode(bind(_hashes(words_of(F.col("text"))), lambda h: _buckets(h, bits))).alias("b"))
        .groupBy("b")
        .agg(F.count(F.lit(1)).alias("r"), F.sum("t").alias("t"))
    )
    rows = [x.to_pylist() for x in counts.select("b", "r", "t").toArrow().columns]  # 2 ** bits rows at most
    all_r, all_t = sum(rows[1]), sum(rows[2])
    ratios = [0] * (1 << bits)
    if all_t:
        for b, r, t in zip(*rows, strict=True):
            ratios[b] = round(SCALE * math.log((t + pseudo) / (r / all_r * all_t + pseudo)))
    return ratios


def rule_columns(text: Column) -> dict[str, Column]:
    """The counts on which the base rules stand, apart from those of words."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    return {
        "word_chars": F.length(F.regexp_replace(body, f"[{SPACE}]+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(body, "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }


def judge_quality(docs: DataFrame, ratios: list[int], *, threshold: float = THRESHOLD, min_words: int = 20, width: int = 8) -> DataFrame:
    """All columns of ``docs`` plus the counts, the score and the verdict.

    Columns of ``docs`` whose names clash with the added ones are replaced.
    """
    bits = len(ratios).bit_length() - 1
    # A subquery of one row, as a literal of so many numbers fills every text of the plan. It is
    # used once, so that it is folded into the projection and no row carries it.
    known = docs.sparkSession.createDataFrame([(ratios,)], "ratios array<bigint>").scalar()

    cut = round(threshold * SCALE)

    def told(x: Column) -> Column:
        n, repeats, total, grams = (x.getField(c) for c in ("n_words", "n_repeat_words", "sum", "grams"))
        failed = (n < min_words) | (100 * repeats > 30 * n)
        return F.struct(
            n.alias("n_words"),
            repeats.alias("n_repeat_words"),
            failed.alias("base_failed"),
            F.when(grams > 0, total / grams / SCALE).otherwise(F.lit(0.0)).alias("score"),
            (~failed & (total >= F.lit(cut) * grams)).alias("kept"),
        )

    def per_words(ratio: Column, words: Column) -> Column:
        def per_hash(h: Column) -> Column:
            def summed(b: Column) -> Column:
                total = F.aggregate(b, F.lit(0).cast("long"), lambda s, i: s + F.get(ratio, i))
                return bind(F.struct(F.size(h).cast("long").alias("n_words"), _repeats(h, width).alias("n_repeat_words"), total.alias("sum"), F.size(b).cast("long").alias("grams")), told)

            return bind(_buckets(h, bits), summed)

        return bind(_hashes(words), per_hash)

    # One expression gives all that rests on the words: a filter on one of its fields evaluates it once.
    with_known = docs.withColumn("__known", known)
    judged = with_known.withColumn("__w", bind(F.col("__known"), lambda k: per_words(k, words_of(F.col("text"))))).drop("__known")
    return judged.withColumns(rule_columns(F.col("text")) | {c: F.col(f"__w.{c}") for c in ("n_words", "n_repeat_words", "base_failed", "score", "kept")}).drop("__w")
