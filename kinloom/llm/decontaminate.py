"""Benchmark decontamination by n-gram seeds and Smith-Waterman alignment.

1. Every test item gives its word ``k``-grams. Items are of 16 classes by their number of
   words (powers of two from 8). A bit table, sized by the benchmark and 32 MB at
   most, says of which classes the items are that may hold an n-gram.
2. A task reads it for a document's k-grams, class by class. Around hits that lie dense enough
   for the least demanding item of the class a passage is cut, with as many words on each
   side as an alignment that scores enough can span for the class's longest item.
   So the reach of a hit follows the items that have it, not the longest of all.
3. Passages are all that leaves the scan. Their hits join the seeds of the items by hash: the
   rarest k-grams of each, by the number of passages that hold them. A passage and an item
   that share enough k-grams (a tenth of the item's, two at least, or the only one) are a
   candidate pair. Of ``n`` k-grams of which ``m`` must be shared, one is among the ``n - m + 1``
   rarest, so the commonest ``m - 1`` are no seeds and no pair is lost for it.
4. Local alignment of words (match 2, other word -1, gap -1) scores the pair as a
   share of the best possible, so edits, insertions and swaps cost in
   proportion. Pairs of at least ``least`` are leaks.

Of ``n`` words with some replaced, at least ``0.2 n - 2`` k-grams stay where the score reaches
0.6, so items of 18 words and more are found whichever words these are. Copies with a word
put in after every other one have no seed and are not found.

Words are lower-cased (A-Z) and bare of ASCII punctuation. Defined cases: null or
blank texts and items give nothing, nor do empty tables; an item of fewer than ``k`` words
is one seed, and matches the whole run only; repeated rows of a document or item give
one pair per pair of ids; null ids are kept as null; the filter decides row by row, by
id and text, so rows without id or with another's id are judged on their own text; very long
texts and items are read whole; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import string
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinloom.llm import grams
from kinloom.llm.common import row_name, settle, ship, without_rows

CLASSES, LEAST_BITS, MOST_BITS = 16, 18, 24
_DROP = string.punctuation.encode()


def bare_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation; those of nothing else vanish."""
    return text.lower().translate(None, _DROP).split() if text else []


def _grams(words: list[bytes], known, k: int) -> np.ndarray:
    return grams.ngrams(grams.word_hashes(words, known), k)


def class_of(n_words: int) -> int:
    return min(CLASSES - 1, max(0, (n_words - 1).bit_length() - 3))


def _item_grams(batches, k: int):
    known = grams.WordHashes()
    for batch in batches:
        words = [bare_words(t) for t in batch.column("text").to_pylist()]
        keys = [np.unique(_grams(w, known, k)) for w in words]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id").cast(pa.int64()), pa.array([len(w) for w in words], pa.int64()), pa.array([class_of(len(w)) for w in words], pa.int32()), pa.array([b" ".join(w) for w in words], pa.binary()), pa.array([x.view(np.int64) for x in keys], pa.list_(pa.int64()))],
            ["item_id", "n_words", "class", "words", "grams"],
        )


def _dense(at: np.ndarray, reach: int, need: int) -> np.ndarray:
    """Hits with at least ``need`` hits within ``reach`` words, themselves included."""
    return at[np.searchsorted(at, at + reach, "right") - np.searchsorted(at, at - reach, "left") >= need]


def _passages(batches, slots, lengths: list[int], k: int, classes: list[tuple[int, int, int]]):
    """Passages of each document around dense hits, by class of items.

    ``lengths`` are the gram lengths to try: ``k`` and those of shorter items.
    ``classes`` has the class, its reach in words and its least number of seeds.
    """
    known = grams.WordHashes()
    schema = pa.schema([("row", pa.binary()), ("doc_id", pa.int64()), ("class", pa.int32()), ("start", pa.int64()), ("words", pa.binary()), ("grams", pa.list_(pa.int64()))])
    table = slots.value
    shift = np.uint64(65 - len(table).bit_length())
    out: list[tuple] = []
    for doc_id, text in grams.rows_of(batches, "doc_id", "text"):
        words = bare_words(text)
        hashes = grams.word_hashes(words, known)
        found = []
        for length in lengths:
            if len(words) >= length:
                g = grams.ngrams(hashes, length)
                marks = table[(g >> shift).astype(np.int64)]
                at = np.flatnonzero(marks)
                found.append((at, g[at], marks[at]))
        if not any(len(x) for x, _, _ in found):
            continue
        at, keys, marks = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(at, kind="stable")
        at, keys, marks = at[order], keys[order], marks[order]
        row = None
        for number, reach, need in classes:
            own = (marks >> np.uint16(number)) & np.uint16(1) == 1
            live = _dense(at[own], reach, need)
            if not len(live):
                continue
            row = row or row_name(doc_id, text)
            for run in np.split(live, np.flatnonzero(np.diff(live) > reach) + 1):
                first, last = int(run[0]), int(run[-1])
                low = max(0, first - reach)
                out.append((row, doc_id, number, low, b" ".join(words[low : last + k + reach]), np.unique(keys[own & (at >= first) & (at <= last)]).view(np.int64)))
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)


def align(item: list[bytes], passage: list[bytes], match: int = 2, other: int = -1, gap: int = 1) -> tuple[int, int]:
    """Best local alignment score and the passage word after which it ends.

    Row by row: a gap run along the row is a running maximum of scores raised
    by ``gap`` per step.
    """
    ids: dict[bytes, int] = {}
    a = [ids.setdefault(w, len(ids)) for w in item]
    b = np.array([ids.get(w, -1) for w in passage])
    steps = gap * np.arange(len(b) + 1)
    row = np.zeros(len(b) + 1, np.int64)
    best, end = 0, 0
    scores = {x: np.where(b == x, match, other) for x in set(a)}
    for x in a:
        now = np.maximum(row - gap, 0)
        now[1:] = np.maximum(now[1:], row[:-1] + scores[x])
        row = np.maximum.accumulate(now + steps) - steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


FOUND = "row binary, doc_id long, item_id long, score double, end_word long, item_words long"


def _aligned(batches):
    done: dict = {}
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for row, doc_id, item_id, start, item, passage, n in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "item_id", "start", "item", "words", "n_words")), strict=True):
            if (item, passage) not in done:
                if len(done) > 20_000:
                    done.clear()
                done[item, passage] = align(item.split(), passage.split())
            score, end = done[item, passage]
            for x, v in zip(out, (row, doc_id, item_id, score / (2 * n), start + end, n), strict=True):
                x.append(v)
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["row", "doc_id", "item_id", "score", "end_word", "item_words"])


def passages_of(docs: DataFrame, benchmark: DataFrame, k: int, least: float) -> tuple[DataFrame, DataFrame] | None:
    """Items, and the passages of documents around their seeds; None without items."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    items = items.mapInArrow(partial(_item_grams, k=k), "item_id long, n_words long, class int, words binary, grams array<long>").where("n_words > 0").distinct()
    own = F.size("grams")
    items = items.withColumn("need", F.least(own, F.greatest(F.lit(2), F.ceil(own / 10))).cast("long")).withColumn("iid", F.monotonically_increasing_id())
    items = settle(items, "items")
    known = items.groupBy("class").agg(F.max("n_words").alias("most"), F.min("need").alias("need"), F.sum(F.size("grams")).alias("seeds"), F.collect_set(F.least("n_words", F.lit(k))).alias("lengths")).collect()  # a row per class
    if not known:
        return None
    bits = min(MOST_BITS, max(LEAST_BITS, sum(r.seeds for r in known).bit_length() + 6))
    marked = items.select("class", F.explode("grams").alias("gram")).groupBy(F.shiftrightunsigned("gram", 64 - bits).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1, class)")).alias("marks")).toArrow()  # 2 ** bits rows at most
    slots = np.zeros(1 << bits, np.uint16)
    slots[marked["slot"].to_numpy()] = marked["marks"].to_numpy().astype(np.uint16)
    classes = sorted((r["class"], math.ceil((3 - 2 * least) * r.most) + k, r.need) for r in known)
    scan = partial(_passages, slots=spark.sparkContext.broadcast(slots), lengths=sorted({x for r in known for x in r.lengths}), k=k, classes=classes)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = texts.mapInArrow(scan, "row binary, doc_id long, class int, start long, words binary, grams array<long>")
    return items, settle(found.withColumn("pid", F.monotonically_increasing_id()), "passages")


def rare_seeds(items: DataFrame, hits: DataFrame) -> DataFrame:
    """``iid, class, gram``: the k-grams by which an item is looked for.

    Those that no passage holds are left out first; of the ``n`` that are held, the
    ``n - need + 1`` that the fewest passages hold are seeds, none where ``n < need``.
    """
    held = hits.groupBy("gram", "class").agg(F.count(F.lit(1)).alias("held"))
    listed = items.select("iid", "need", "class", F.explode("grams").alias("gram")).join(held, ["gram", "class"])
    of_item = Window.partitionBy("iid")
    ranked = listed.withColumn("rank", F.row_number().over(of_item.orderBy("held", "gram"))).withColumn("n", F.count(F.lit(1)).over(of_item))
    return ranked.where("rank <= n - need + 1").select("iid", "class", "gram")


def _scored(docs: DataFrame, benchmark: DataFrame, k: int, least: float) -> DataFrame:
    """Every passage and item that align well enough, see ``FOUND``."""
    cut = passages_of(docs, benchmark, k, least)
    if cut is None:
        return docs.sparkSession.createDataFrame([], FOUND)
    items, passages = cut
    hits = passages.select("pid", "class", F.explode("grams").alias("gram"))
    pairs = hits.join(rare_seeds(items, hits), ["gram", "class"]).select("pid", "iid").distinct()
    named = pairs.join(items.select("iid", "item_id", "n_words", "need", F.col("words").alias("item"), F.col("grams").alias("own")), "iid")
    ready = named.join(passages.select("pid", "row", "doc_id", "start", "words", "grams"), "pid").where(F.size(F.array_intersect("grams", "own")) >= F.col("need"))
    return ready.select("row", "doc_id", "item_id", "start", "item", "words", "n_words").mapInArrow(_aligned, FOUND).where(F.col("score") >= least)


def leaks(docs: DataFrame, benchmark: DataFrame, *, k: int = 3, least: float = 0.6) -> DataFrame:
    """``doc_id, item_id, score, end_word, item_words`` of every leak, best passage each."""
    best = _scored(docs, benchmark, k, least).groupBy("doc_id", "item_id").agg(F.max(F.struct("score", (-F.col("end_word")).alias("e"), "item_words")).alias("b"))
    return best.select("doc_id", "item_id", "b.score", (-F.col("b.e")).alias("end_word"), "b.item_words")


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, k: int = 3, least: float = 0.6) -> DataFrame:
    """Rows of ``docs`` whose text holds no leak."""
    return without_rows(docs, _scored(docs, benchmark, k, least).select("row"))
