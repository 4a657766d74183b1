"""Exact Jaccard self-join on word n-grams, and its groups.

Every document is the set of its distinct n-grams. Documents with one set form a
class, and classes are joined:

* a total order puts rare n-grams first, by two tables of ``2 ** bits`` counts over the
  whole corpus: of n-grams, for those that many texts share, and of words, for
  those of common words. Any order gives the same join; a good one few candidates;
* two sets that reach the threshold share an n-gram among the first ``n - need + 1``
  of each (prefix filter), and at the first shared one enough must be left
  (positional filter) in sets of like size (length filter);
* 512 parity bits per set (each n-gram flips one) bound the symmetric difference
  from below and so refuse, without loss, most of what the other filters pass
  (suffix filter over the whole set); pairs of long sets, which fill 512 bits, are
  compared once more by bits in proportion to their size;
* a pair is taken at its first shared n-gram, told by the few shared ones before
  it, made distinct, and verified once on the full sets.

``jaccard_groups`` counts links, so it makes every pair that links. ``without_near_copies`` only
needs groups: it links by pivots first, and then makes only pairs across the groups found.

No cap anywhere: only n-grams that a single class has in its prefix are dropped, and one that
more than ``SPLIT`` classes have is dealt over tasks by parts of them.

Defined cases: a text without words, or null, has no set and links with nothing
(its component is its own id); a text of fewer words than ``k`` is one n-gram;
repeated rows are copies of each other; a row without id gets the component of its
copies, null if none has an id; rows that share an id are rows of their own; extra columns
are ignored, whatever their names; an empty table gives no rows. n-grams are held as 64-bit
hashes.
"""

from __future__ import annotations

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinloom.llm import grams
from kinloom.llm.common import row_key, settle, ship, without_rows
from kinloom.llm.graph import components

SKETCH_LONGS = 8
LAST = 2
PIVOTS, MANY = 4, 16
SPLIT = 1024


def _frequencies(batches, k: int, bits: int):
    """Counts by bucket: of n-grams once per text, and (from ``2 ** bits`` on) of words."""
    known, counts = grams.WordHashes(), np.zeros(2 << bits, np.int64)
    shift = np.uint64(64 - bits)
    pending, held = [], 0

    def add():
        nonlocal pending, held
        counts[:] += np.bincount(np.concatenate(pending), minlength=2 << bits)
        pending, held = [], 0

    for (text,) in grams.rows_of(batches, "text"):
        hashes = grams.word_hashes(grams.words(text), known)
        pending += [(np.unique(grams.ngrams(hashes, k)) >> shift).astype(np.int64), (hashes >> shift).astype(np.int64) + (1 << bits)]
        held += 2 * len(hashes)
        if held > 1_000_000:
            add()
    if pending:
        add()
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["bucket", "n"])


def rarity(docs: DataFrame, k: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For the order: how heavy each bucket of n-grams is, and the weight of each bucket of words.

    An n-gram is heavy by the power of two by which its bucket passes the mean (an n-gram
    that many texts share does so). Among those that are not, the sum of the words'
    logarithmic frequencies tells how easily two texts share one by chance.
    """
    parts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(partial(_frequencies, k=k, bits=bits), "bucket int, n long")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # 2 ** (bits + 1) rows at most
    counts = np.zeros(2 << bits, np.int64)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    shared, words = counts[: 1 << bits], counts[1 << bits :]
    heavy = np.log2(np.maximum(shared, 1) / max(1.0, shared.mean()))
    return np.maximum(heavy, 0).astype(np.int16), np.round(256 * np.log2(words + 1)).astype(np.int32)


def rare_first(text: bytes | None, known: grams.WordHashes, order: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as a sorted set, and in the common order."""
    heavy, weight = order
    shift = np.uint64(65 - len(heavy).bit_length())
    hashes = grams.word_hashes(grams.words(text), known)
    all_grams = grams.ngrams(hashes, k)
    s, at = np.unique(all_grams, return_index=True)
    per_word = weight[(hashes >> shift).astype(np.int64)]
    k = min(k, len(hashes))
    sums = sum((per_word[j : len(per_word) - k + 1 + j] for j in range(k)), np.zeros(len(all_grams), np.int64))
    return s, s[np.lexsort((s, sums[at], heavy[(s >> shift).astype(np.int64)]))]


def long_set(percent: int) -> int:
    """Sets larger than this have a second sketch, of a bit per one to two n-grams.

    Up to here, the difference that a link allows is a third of the bits of the first at most;
    chance alone makes half of them differ.
    """
    return 64 * SKETCH_LONGS * (100 + percent) // (6 * (100 - percent)) if percent < 100 else 64 * SKETCH_LONGS * 8


def need(n, percent: int):
    """Least overlap of a set of n with any set that it links to."""
    return -(-percent * n // 100)


def parity_bits(s: np.ndarray, bits: int) -> np.ndarray:
    """One bit per residue: whether an odd number of the hashes has it."""
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def far_apart(a: np.ndarray, b: np.ndarray) -> int:
    """Differing bits of two sketches; the longer is folded to the shorter."""
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.unpackbits(a ^ b).sum())


def _features(batches, order, k: int, percent: int):
    known = grams.WordHashes()
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for text in batch.column("text").to_pylist():
            s, ranked = rare_first(text, known, order.value, k)
            out[0].append(len(s))
            if len(s):
                out[1].append(grams.set_digest(s))
                out[2].append(ranked[: len(s) - need(len(s), percent) + 1].view(np.int64))
                out[3].append(parity_bits(s, 64 * SKETCH_LONGS).view(np.int64))
                out[4].append(parity_bits(s, 1 << (len(s) - 1).bit_length()).tobytes() if len(s) > long_set(percent) else None)
            else:
                for x in out[1:]:
                    x.append(None)
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), batch.column("handle").cast(pa.int64()), batch.column("row").cast(pa.binary()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], longs), pa.array(out[3], longs), pa.array(out[4], pa.binary())],
            ["doc_id", "handle", "row", "n", "digest", "prefix", "parity", "fine"],
        )


def _alike(batches, percent: int):
    """Pairs of long sets whose finer sketches do not refuse them."""
    for batch in batches:
        kept = []
        for i, (na, nb, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "fine_a", "fine_b")), strict=True)):
            overlap = -(-percent * (na + nb) // (100 + percent))
            if far_apart(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= na + nb - 2 * overlap:
                kept.append(i)
        yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))


def _sets(batches, k: int):
    """Sets of texts, with the hash by which each was asked for."""
    known = grams.WordHashes()
    for batch in batches:
        sets = [np.unique(grams.ngrams(grams.word_hashes(grams.words(t), known), k)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([grams.set_digest(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), batch.column("handle")], ["digest", "shingles", "handle"])


def _far(a: str, b: str) -> Column:
    """Bits in which two parity sketches differ."""
    return reduce(lambda x, y: x + y, (F.bit_count(F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))) for i in range(SKETCH_LONGS)))


def _overlap(na: str, nb: str, percent: int) -> Column:
    """Least common n-grams of linked sets: ceil(p * (na + nb) / (100 + p))."""
    return F.expr(f"(({percent} * ({na} + {nb}) + {99 + percent}) div {100 + percent})")


def prefixes(reps: DataFrame) -> DataFrame:
    """``key, rep, n, pos, held`` per n-gram that ``held`` > 1 classes have in their prefixes."""
    listed = reps.select("rep", "n", F.posexplode("prefix").alias("pos", "key"))
    shared = listed.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    return listed.join(shared, "key")


def _told(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """Rows with what the join of candidates asks of a class, and the shared n-grams ``before``."""
    of_rep = Window.partitionBy("rep").orderBy("pos")
    before = F.array_compact(F.array(*(F.lag("key", i).over(of_rep) for i in range(1, LAST + 1))))
    return rows.join(reps, "rep").withColumn("before", before)


def _may_link(percent: int) -> Column:
    """Length, positional and parity filter on a shared n-gram of ``_a`` and ``_b``."""
    overlap = _overlap("n_a", "n_b", percent)
    return (
        (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        & (F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) >= overlap)
        & (_far("parity_a", "parity_b") <= F.col("n_a") + F.col("n_b") - 2 * overlap)
    )


def _sides(rows: DataFrame) -> list[DataFrame]:
    return [rows.select("key", *(F.col(c).alias(f"{c}_{s}") for c in rows.columns if c != "key")) for s in "ab"]


def _n_parts() -> Column:
    """Into how many parts the classes of an n-gram are split."""
    return F.ceil(F.col("held") / SPLIT)


def _own_part() -> Column:
    return F.pmod(F.xxhash64("rep"), _n_parts())


def _every_part() -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), _n_parts() - 1))


def _finely(joined: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a, b``; of long sets those that the finer sketches let through."""
    pairs = settle(joined.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), "n_a", "n_b").distinct(), "sketched")
    both_long = F.least("n_a", "n_b") > long_set(percent)
    fine = reps.where("fine is not null").select("rep", "fine")
    a, b = (fine.select(F.col("rep").alias(c), F.col("fine").alias(f"fine_{c}")) for c in "ab")
    long = pairs.where(both_long).join(a, "a").join(b, "b").mapInArrow(partial(_alike, percent=percent), "a long, b long")
    return pairs.where(~both_long).select("a", "b").unionByName(long)


def candidates(rows: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a, b`` of classes that the filters let through.

    Where ``rows`` tell the ``root`` of a class, pairs of one root are left out. Of an n-gram
    that many classes have, every part meets all of them in a task of its own.
    """
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("rep_a") < F.col("rep_b")))
    new = ordered & (F.col("root_a") != F.col("root_b")) if "root" in rows.columns else ordered
    accepted = new & _may_link(percent) & ~F.arrays_overlap("before_a", "before_b")
    few, many = rows.where(F.col("held") <= SPLIT).drop("held"), rows.where(F.col("held") > SPLIT)
    a, b = _sides(few)
    part, _ = _sides(many.withColumn("part", _own_part()).drop("held"))
    _, every = _sides(many.withColumn("part", _every_part()).drop("held"))
    split = part.withColumnRenamed("part_a", "part").join(every.withColumnRenamed("part_b", "part"), ["key", "part"])
    ends = ("rep_a", "rep_b", "n_a", "n_b")
    return _finely(a.join(b, "key").where(accepted).select(*ends).unionByName(split.where(accepted).select(*ends)), reps, percent)


def pivot_pairs(rows: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a, b`` of classes with the pivots of their n-grams, linear in ``rows``.

    Only n-grams that ``MANY`` classes have are asked: the pairs of fewer are few. The pivot
    of an n-gram is one of those that have it, by a hash that takes ``PIVOTS`` turns,
    so that a cluster has a few of them. The classes of an n-gram come in parts, each with a copy of
    the pivot.
    """
    told = rows.where(F.col("held") >= MANY).select("key", "rep", "n", "pos", "held").join(reps.select("rep", "parity"), "rep")
    turn = F.xxhash64("rep", F.pmod("key", F.lit(PIVOTS)))
    pivots = told.groupBy("key").agg(F.min(F.struct(turn.alias("_h"), "rep", "n", "pos", "parity")).alias("p"), F.max("held").alias("held"))
    own, _ = _sides(told.withColumn("part", _own_part()).drop("held"))
    pivots = pivots.select("key", _every_part().alias("part"), *(F.col(f"p.{c}").alias(f"{c}_b") for c in ("rep", "n", "pos", "parity")))
    joined = own.withColumnRenamed("part_a", "part").join(pivots, ["key", "part"]).where((F.col("rep_a") != F.col("rep_b")) & _may_link(percent))
    low, high = F.struct("n_a", "rep_a"), F.struct("n_b", "rep_b")
    first = F.when(low < high, low).otherwise(F.struct(F.col("n_b").alias("n_a"), F.col("rep_b").alias("rep_a")))
    last = F.when(low < high, high).otherwise(F.struct(F.col("n_a").alias("n_b"), F.col("rep_a").alias("rep_b")))
    return _finely(joined.select(first.alias("f"), last.alias("l")).select("f.rep_a", "l.rep_b", "f.n_a", "l.n_b"), reps, percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """All links ``u, v`` with the copies of both, and fewer ones that hold the same components together.

    Sets of one group of candidates differ little, so each is told once by what parts it
    from its group's centre, the class with most candidates. Two such differences give
    the symmetric difference of their sets exactly, and a pair moves them alone.
    A link between two classes that both link to their centre holds nothing more.
    """
    both = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))
    degree = both.groupBy("rep").agg(F.count(F.lit(1)).alias("_d"))
    groups = settle(components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "rep"), "candidates")
    centres = groups.join(degree, "rep").groupBy("root").agg(F.max(F.struct("_d", (-F.col("rep")).alias("c"))).alias("_m")).select("root", (-F.col("_m.c")).alias("centre"))
    middle = sets.select(F.col("rep").alias("centre"), F.col("n").alias("n_c"), F.col("shingles").alias("shingles_c"))
    apart = F.concat(F.array_except("shingles", "shingles_c"), F.array_except("shingles_c", "shingles"))
    told = sets.join(groups.join(centres, "root").drop("root"), "rep").join(middle, "centre").select("rep", "n", "copies", "centre", "n_c", apart.alias("apart"))
    reach = lambda size, x, y: size <= F.col(x) + F.col(y) - 2 * _overlap(x, y, percent)
    told = settle(told.withColumn("near", reach(F.size("apart"), "n", "n_c")).drop("n_c"), "apart")
    a, b = (told.select(*(F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "copies", "near", "apart"))) for s in "ab")
    checked = pairs.join(a, F.col("a") == F.col("rep_a")).join(b, F.col("b") == F.col("rep_b"))
    differ = F.size("apart_a") + F.size("apart_b") - 2 * F.size(F.array_intersect("apart_a", "apart_b"))
    links = settle(checked.where(reach(differ, "n_a", "n_b")).select(F.col("a").alias("u"), F.col("b").alias("v"), "copies_a", "copies_b", (F.col("near_a") & F.col("near_b")).alias("held")), "links")
    star = told.where("near and rep <> centre").select(F.col("rep").alias("u"), F.col("centre").alias("v"))
    return links.drop("held"), settle(links.where("not held").select("u", "v").unionByName(star), "holding")


def _classes(docs: DataFrame, k: int, percent: int, bits: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Texts by handle, rows (``doc_id, row, n, digest``), classes, and one row of features a class.

    ``row`` names a row by id and text. A class carries its copies, its least id and the
    first of its rows by id (null last), then by name.
    """
    spark = docs.sparkSession
    ship(spark)
    order = spark.sparkContext.broadcast(rarity(docs, k, bits))
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), row_key().alias("row")).withColumn("handle", F.xxhash64("doc_id", "text"))
    made = raw.mapInArrow(partial(_features, order=order, k=k, percent=percent), "doc_id long, handle long, row binary, n long, digest binary, prefix array<long>, parity array<long>, fine binary")
    feats = settle(made.withColumn("rid", F.monotonically_increasing_id()), "features")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    classes = feats.where("n > 0").groupBy("digest").agg(F.min("rid").alias("rep"), F.min("doc_id").alias("label"), F.count(F.lit(1)).alias("copies"), first)
    classes = settle(classes, "classes")
    reps = settle(classes.select("rep", "digest", "copies").join(feats.select(F.col("rid").alias("rep"), "handle", "n", "prefix", "parity", "fine"), "rep"), "reps")
    return raw.select("handle", "text"), feats.select("doc_id", "row", "n", "digest"), classes, reps


def _links(raw: DataFrame, reps: DataFrame, pairs: DataFrame, k: int, percent: int, most_broadcast: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs verified on whole texts, see ``_verified``.

    The texts are asked for by a hash of id and text, as an id may be null; a collision only
    fetches a text that no digest asks for, so a class has one set. The hashes are broadcast only after they are
    counted (8 MB at most), else joined by a shuffle.
    """
    pairs = settle(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    asked = settle(ends.join(reps.select("rep", "digest", "handle", "n", "copies"), "rep"), "asked")
    handles = asked.select("handle").distinct()
    handles = F.broadcast(handles) if handles.count() <= most_broadcast else handles
    sets = raw.join(handles, "handle", "left_semi").distinct().mapInArrow(partial(_sets, k=k), "digest binary, shingles array<long>, handle long")
    sets = settle(sets.join(asked.select("digest", "handle", "rep", "n", "copies"), ["digest", "handle"]).drop("digest", "handle"), "sets")
    return _verified(pairs, sets, percent)


def _grouped(classes: DataFrame, roots: DataFrame) -> DataFrame:
    return settle(classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep")), "grouped")


def jaccard_groups(docs: DataFrame, *, k: int = 3, percent: int = 90, bits: int = 18, most_broadcast: int = 1_000_000) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row of ``docs``.

    ``component_id`` is the least id reachable over links, ``n_links`` how many other
    rows a row links to.
    """
    raw, feats, classes, reps = _classes(docs, k, percent, bits)
    rows = settle(_told(prefixes(reps), reps.select("rep", "parity")), "prefixes")
    links, holding = _links(raw, reps, candidates(rows, reps, percent), k, percent, most_broadcast)
    grouped = _grouped(classes, components(holding))
    both = links.select(F.col("u").alias("rep"), F.col("copies_b").alias("_c")).unionByName(links.select(F.col("v").alias("rep"), F.col("copies_a").alias("_c")))
    degree = both.groupBy("rep").agg(F.sum("_c").alias("others"))
    least = grouped.groupBy("root").agg(F.min("label").alias("component_id"))
    named = grouped.join(least, "root").join(degree, "rep", "left").select("digest", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return feats.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(named, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def near_copy_groups(docs: DataFrame, k: int, percent: int, bits: int, most_broadcast: int) -> tuple[DataFrame, DataFrame]:
    """Rows, and classes with the ``root`` of their group; the links are not counted.

    Classes first meet the pivots of their n-grams. What these links hold together is one
    group, and n-grams that a single group has are done with. The join of what is left
    only makes pairs across groups, so a large cluster costs its size and not its square.
    """
    raw, feats, classes, reps = _classes(docs, k, percent, bits)
    rows = settle(prefixes(reps), "prefixes")
    _, holding = _links(raw, reps, pivot_pairs(rows, reps, percent), k, percent, most_broadcast)
    rooted = reps.select("rep", "parity").join(components(holding).withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    many = rows.where(F.col("held") >= MANY).select("key", "rep").join(rooted.select("rep", "root"), "rep")
    done = settle(many.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low = _high").select("key"), "done")
    told = settle(_told(rows.join(done, "key", "left_anti"), rooted), "told")
    _, across = _links(raw, reps, candidates(told, reps, percent), k, percent, most_broadcast)
    return feats, _grouped(classes, components(settle(holding.unionByName(across), "holding")))


def without_near_copies(docs: DataFrame, *, k: int = 5, percent: int = 80, bits: int = 18, most_broadcast: int = 500_000) -> DataFrame:
    """One row of every group of near copies: the one with the least id, then the least name.

    Rows are told by id and text, so that one without an id, or with an id that another
    text has too, stays or goes on its own account; of rows equal in both one
    stays. Rows without words are in no group and all stay.
    """
    feats, grouped = near_copy_groups(docs, k, percent, bits, most_broadcast)
    stays = grouped.groupBy("root").agg(F.min("first").alias("_first")).select("root", F.col("_first.row").alias("stays"))
    told = feats.where("n > 0").join(grouped.join(stays, "root").select("digest", "stays"), "digest")
    repeated = settle(told.where("row = stays").groupBy("row").count().where("count > 1").select("row"), "repeated")
    kept = without_rows(docs, told.where("row <> stays").select("row").unionByName(repeated), most_broadcast)
    again = repeated.withColumnRenamed("row", "__row")
    keyed = docs.withColumn("__row", row_key()).join(F.broadcast(again) if again.count() <= most_broadcast else again, "__row", "left_semi")
    return kept.unionByName(keyed.dropDuplicates(["__row"]).select(*docs.columns))
