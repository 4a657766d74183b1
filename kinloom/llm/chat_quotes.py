"""Chat formatting by quotation linking.

Lines that begin with ``>`` marks are quotes, as deep as they have marks. Runs of
lines of one depth are passages; lines are normalised (white space, case, marks) and hashed.

A message offers what it can be quoted by: the hashes of all its own words, of each of
its runs and paragraphs (so that a quote may be wrapped anew), of each line, and of every
2, 4, 8... lines on end, each made of two halves. A passage asks by the hash of its words,
and by the first and the last 2, 4, 8... of its lines, which together cover it: parts of
a message are found whatever they are. It links to the latest earlier turn of its
conversation that offers its words or both halves, else to the first message of another
conversation that does. Where the halves are found apart, the earlier (outside: the later)
of the two places is asked for the other half.

The parent of a message is the latest original of its shallowest linked passage in the
conversation. A conversation is then its reply trees in order of their first turn, each in
order of turns, so that a message follows what it answers, with quotes taken out.

Hot hashes cost one row per task and conversation, and a conversation is never gathered: places
come from a range-partitioned sort of all messages.

Defined cases: a null text is an empty message; a null conversation, turn or role is
kept, and messages without conversation or turn link with nothing; repeated
rows are separate messages with one set of links; a quote that no one wrote has no
original and is taken out all the same; a passage of under ``SHORT`` characters tells nothing
outside its conversation and links within it alone; only ``\\n`` ends a line, other characters of
a body stay as they are; texts of any length are read whole; an empty table gives no rows; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinloom.llm.common import settle, ship

_MARKS = re.compile(r"^\s{0,3}((?:>\s?)+)")
SHORT = 4


def depth_of(line: str) -> tuple[int, str]:
    """Depth of a line and what stands behind its marks."""
    m = _MARKS.match(line)
    return (m[1].count(">"), line[m.end() :]) if m else (0, line)


def passages(text: str | None) -> list[tuple[int, list[str]]]:
    """Runs of lines of one depth; a blank line without marks ends no run of depth 0."""
    out: list[tuple[int, list[str]]] = []
    for line in (text or "").split("\n"):
        depth, rest = depth_of(line)
        if not out or out[-1][0] != depth:
            out.append((depth, []))
        out[-1][1].append(rest)
    return out


def flat(passage: str) -> str:
    return " ".join(passage.casefold().split())


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def key_of(passage: str) -> bytes | None:
    """Hash of a normalised passage; None for a blank one."""
    words = flat(passage)
    return _hash(words.encode("utf-8", "replace")) if words else None


def chains(lines: list[str]) -> list[list[bytes]]:
    """Hashes of all runs of 1, 2, 4... lines that are not blank, by their first line."""
    now = [k for x in lines if (k := key_of(x))]
    out, size = [], 1
    while now:
        out.append(now)
        now = [_hash(now[i] + now[i + size]) for i in range(len(now) - size)]
        size *= 2
    return out


def offers(parts: list[list[str]]) -> set[bytes]:
    """Keys under which a message of these runs can be quoted."""
    lines = [x for p in parts for x in p]
    body = "\n".join(lines)
    told = [body, *("\n".join(p) for p in parts), *re.split(r"\n\s*\n", body)]
    return {k for p in told if (k := key_of(p))} | {k for level in chains(lines) for k in level}


def asks(lines: list[str]) -> dict | None:
    """What a quoted passage asks by; None for a blank one."""
    levels = chains(lines)
    if not levels:
        return None
    text = "\n".join(lines)
    return {"all": key_of(text), "head": levels[-1][0], "tail": levels[-1][-1], "short": len(flat(text)) < SHORT}


def _parsed(batches):
    quote = pa.list_(pa.struct([("depth", pa.int64()), ("all", pa.binary()), ("head", pa.binary()), ("tail", pa.binary()), ("short", pa.bool_())]))
    for batch in batches:
        own, quotes, keys = [], [], []
        for text in batch.column("text").to_pylist():
            parts = passages(text)
            said = [p for d, p in parts if d == 0]
            own.append(re.sub(r"\n{3,}", "\n\n", "\n".join(x for p in said for x in p).strip()))
            quotes.append([{"depth": d, **a} for d, p in parts if d and (a := asks(p))])
            keys.append(sorted(offers(said)))
        names = ["mid", "conv_id", "turn", "role"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(own, pa.string()), pa.array(quotes, quote), pa.array(keys, pa.list_(pa.binary()))], [*names, "body", "quotes", "offers"]
        )


PARSED = "mid long, conv_id long, turn long, role string, body string, quotes array<struct<depth long, all binary, head binary, tail binary, short boolean>>, offers array<binary>"


def link_quotes(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed messages, and ``mid, depth, conv_id, turn, from_conv, from_turn`` per linked passage."""
    ship(messages.sparkSession)
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), "text").withColumn("mid", F.monotonically_increasing_id())
    parsed = settle(rows.mapInArrow(_parsed, PARSED), "messages")
    placed = parsed.where("conv_id is not null and turn is not null")
    asked = placed.select("mid", "conv_id", "turn", F.posexplode("quotes").alias("at", "q"))
    keys = asked.select("mid", "conv_id", "turn", "at", "q.short", F.explode(F.array(*(F.struct(F.lit(x).alias("part"), F.col(f"q.{x}").alias("key")) for x in ("all", "head", "tail")))).alias("k")).select("mid", "conv_id", "turn", "at", "short", "k.part", "k.key")
    keys = settle(keys, "asked")
    offered = settle(placed.select("conv_id", "turn", F.explode("offers").alias("key")).join(keys.select("key").distinct(), "key").distinct(), "offered")
    told = _latest_before(keys, offered).join(_first_two(offered), "key", "left")
    outside = F.when(~F.col("short"), F.when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).otherwise(F.col("second")))
    of = lambda value, part: F.max(F.when(F.col("part") == part, value))
    found = told.groupBy("mid", "conv_id", "turn", "at").agg(*(x for p in ("all", "head", "tail") for x in (of(F.col("inside"), p).alias(f"in_{p}"), of(outside, p).alias(f"out_{p}"), of(F.col("key"), p).alias(f"key_{p}"))))
    found = _both_halves(settle(found, "found"), offered)
    here = F.greatest("in_all", "in_both")
    there = F.least("out_all", "out_both")
    linked = found.select("mid", "at", "conv_id", "turn", F.when(here.isNotNull(), F.col("conv_id")).otherwise(there["conv_id"]).alias("from_conv"), F.coalesce(here, there["turn"]).alias("from_turn"))
    depths = asked.select("mid", "at", "q.depth")
    return parsed, linked.where("from_turn is not null").join(depths, ["mid", "at"]).select("mid", "depth", "conv_id", "turn", "from_conv", "from_turn")


def _latest_before(keys: DataFrame, offered: DataFrame) -> DataFrame:
    """Each key asked with ``inside``: the latest earlier turn of its conversation that offers it.

    One ordered pass over offers and questions of a (conversation, key) instead of a
    join, which would pair all with all where one line is said and quoted often.
    """
    same = ["key", "conv_id", "turn"]
    rest = [c for c in keys.columns if c not in same]
    marks = offered.select(*same, *(F.lit(None).cast(keys.schema[c].dataType).alias(c) for c in rest), F.col("turn").alias("said"))
    both = marks.unionByName(keys.withColumn("said", F.lit(None).cast("long")))
    earlier = Window.partitionBy("key", "conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    return both.withColumn("inside", F.max("said").over(earlier)).where("mid is not null").drop("said")


def _first_two(offered: DataFrame) -> DataFrame:
    """``key, first, second``: the first turns of the two least conversations that offer it."""
    by_conv = offered.groupBy("key", "conv_id").agg(F.min("turn").alias("turn"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("conv_id"))
    two = by_conv.withColumn("place", place).where("place <= 2")
    at = lambda n: F.max(F.when(F.col("place") == n, F.struct("conv_id", "turn")))
    return two.groupBy("key").agg(at(1).alias("first"), at(2).alias("second"))


def _both_halves(found: DataFrame, offered: DataFrame) -> DataFrame:
    """Adds ``in_both`` and ``out_both``: a place that offers head and tail, see above."""
    place = F.struct(F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"))
    known = offered.select(place.alias("_place"), F.col("key").alias("_key"))

    def ask(df: DataFrame, head: Column, tail: Column, choose, out: str) -> DataFrame:
        chosen = F.when(head.isNotNull() & tail.isNotNull(), choose(head, tail))
        df = df.withColumn("_c", chosen).withColumn("_k", F.when(head == F.col("_c"), F.col("key_tail")).otherwise(F.col("key_head")))
        apart = (head != tail) & (F.col("key_head") != F.col("key_tail"))
        joined = df.join(known, (df["_c"] == known["_place"]) & (df["_k"] == known["_key"]), "left")
        return joined.withColumn(out, F.when(~apart | F.col("_key").isNotNull(), F.col("_c"))).drop("_c", "_k", "_place", "_key")

    inside = [F.when(F.col(c).isNotNull(), F.struct(F.col("conv_id").alias("conv_id"), F.col(c).alias("turn"))) for c in ("in_head", "in_tail")]
    found = ask(found, *inside, F.least, "in_place").withColumn("in_both", F.col("in_place.turn")).drop("in_place")
    return ask(found, F.col("out_head"), F.col("out_tail"), F.greatest, "out_both")


def _roots(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, root, depth``: pointer doubling over replies to earlier turns."""
    now = settle(parents.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "replies")
    while True:
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("_up"), F.col("depth").alias("_more"))
        step = settle(now.join(up, ["conv_id", "root"], "left"), "replies")
        moved = step.where("_up is not null").limit(1).count()
        now = step.select("conv_id", "turn", F.coalesce("_up", "root").alias("root"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"))
        if not moved:
            return now


def reply_ordered(messages: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, turn, role, body, parent_turn, root_turn, depth, position, n_quotes, n_linked``."""
    parsed, linked = link_quotes(messages)
    linked = settle(linked, "links")
    here = linked.where("from_conv = conv_id")
    shallow = Window.partitionBy("mid")
    parents = (
        here.withColumn("_least", F.min("depth").over(shallow)).where("depth = _least").groupBy("conv_id", "turn").agg(F.max("from_turn").alias("parent"))
    )
    parents = settle(parents, "parents")
    roots = _roots(parents).join(parents, ["conv_id", "turn"])
    counts = linked.groupBy("mid").agg(F.count(F.lit(1)).alias("n_linked"))
    told = (
        parsed.join(roots, ["conv_id", "turn"], "left")
        .join(counts, "mid", "left")
        .select(
            "mid",
            "conv_id",
            "turn",
            "role",
            "body",
            F.col("parent").alias("parent_turn"),
            F.coalesce("root", "turn").alias("root_turn"),
            F.coalesce("depth", F.lit(0)).alias("depth"),
            F.size("quotes").cast("long").alias("n_quotes"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        )
    )
    return _positioned(told)


def _positioned(told: DataFrame) -> DataFrame:
    """Adds ``position`` within the conversation, from a sort over ranges of all rows."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("root_turn").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("mid").asc()]
    laid = settle(told.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = laid.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    starts = sizes.select("_p", (F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_p")) - F.col("_n")).alias("_start"))
    ranked = laid.withColumn("_p", part).join(F.broadcast(starts), "_p").withColumn("_rank", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    firsts = ranked.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("_rank").alias("_first"))
    return ranked.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "turn", "role", "body", "parent_turn", "root_turn", "depth", (F.col("_rank") - F.col("_first")).alias("position"), "n_quotes", "n_linked"
    )
