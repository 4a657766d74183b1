"""Language-model scores by deleted interpolation of 1-, 2- and 3-grams.

``P(w | u v) = l3 c(uvw) / c(uv) + l2 c(vw) / c(v) + l1 c(w) / N + l0 / (V + 1)``, where the
mixture ``l`` depends on how often the context was seen: by powers of two of
``c(uv)``, or of ``c(v)`` where uv was not seen. Part of the training documents is
deleted from the counts, and expectation maximisation fits the mixtures to what was
deleted; scores then use the counts of all training documents.

How counts meet tokens without a row per token:

1. texts become chunks of about ``chunk_tokens`` tokens, one row each: hashes of
   the chunk's distinct words, and its tokens as indices into them;
2. each chunk sends its distinct n-grams with their counts, sorted, delta-coded and
   compressed, to ranges of the hash space. However common an n-gram, a chunk sends it once;
3. a range adds up and sends back, to each chunk, totals in the order asked;
4. a chunk then has every count that its tokens need.

A sender addresses ``2 ** fan_bits`` ranges at most. Where the corpus needs more, groups of
as many chunks first merge what they send to one range into a run, and the runs send on to
finer ranges, level by level; answers come back the same way. So the number of messages
is in proportion to the corpus, by level.

What is sent grows with the distinct n-grams of the chunks, that is with the
corpus; nothing is cut off, pruned or sampled. The driver holds N, V and
a histogram for the mixtures: cells of context state and e-fold halves of the three estimates.

Words are held as 64-bit hashes. 2- and 3-grams have 14 bits more than the number of all
tokens, 64 at most, so whatever the size of the corpus one in 16,384 of them shares its count
with another.

Defined cases: a null or blank text is its end token alone; rows with equal ids are
scored one by one; an empty table gives no rows; without training documents every count is 0
and the score is uniform; a null id counts as the text '' in the folds; a text of any
length is in one chunk; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.llm import grams
from kinloom.llm.common import fold, settle, ship

END, START, BEFORE = np.uint64(0xE4D), np.uint64(0x57A27), np.uint64(0xBEF0)
#: Kinds of chunks by fold: scored only, deleted from the counts when fitting, counted.
SCORED, DELETED, COUNTED = 0, 1, 2
STEPS, NONE, FINE = 2.0, -255, 1024.0  # bins per unit of ln, the bin of 0, parts of a unit in sums
#: States of a context: by c(uv) up to this level, and from here on by c(v) where uv is new.
TOP, NEW = 20, 32
STATES = NEW + 32


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers by byte planes: the empty planes of small ones cost nothing."""
    return len(x).to_bytes(4, "little") + zstandard.compress(x.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unplaned(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data[4:]), np.uint8).reshape(8, int.from_bytes(data[:4], "little"))
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unplaned(data), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return _planes(np.ascontiguousarray(counts, np.int64))


def unpack_counts(data: bytes) -> np.ndarray:
    return _unplaned(data).view(np.int64)


class _Chunk:
    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.tokens: list[int] = []
        self.docs: list[int | None] = []
        self.ends: list[int] = []

    def add(self, doc_id, text) -> None:
        ids = self.ids
        self.tokens += [ids.setdefault(w, len(ids)) for w in grams.words(text)]
        self.tokens.append(-1)
        self.docs.append(doc_id)
        self.ends.append(len(self.tokens))


def _chunked(batches, chunk_tokens: int):
    known = grams.WordHashes()

    def row(kind: int, c: _Chunk):
        hashes = np.concatenate([grams.word_hashes(list(c.ids), known), [END]])
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        tokens = place[np.array(c.tokens, np.int32)]  # -1 is the end, the last
        docs = pa.array([c.docs], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array([kind], pa.int32()), docs, pa.array([c.ends], pa.list_(pa.int64())), pa.array([pack_keys(hashes[order])], pa.binary()), pa.array([zstandard.compress(tokens.tobytes(), 3)], pa.binary()), pa.array([len(c.tokens)], pa.int64())],
            ["kind", "docs", "ends", "words", "tokens", "n"],
        )

    chunks = {k: _Chunk() for k in (SCORED, DELETED, COUNTED)}
    for doc_id, text, f in grams.rows_of(batches, "doc_id", "text", "fold"):
        kind = min(f, COUNTED)
        chunks[kind].add(doc_id, text)
        if len(chunks[kind].tokens) >= chunk_tokens:
            yield row(kind, chunks[kind])
            chunks[kind] = _Chunk()
    for kind, c in chunks.items():
        if c.docs:
            yield row(kind, c)


def _one_by_one(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _keys(row: dict, bits: int):
    """Tokens, places of first tokens, and the keys of words (by number), 2- and 3-grams (by token)."""
    words, tokens = unpack_keys(row["words"]), np.frombuffer(zstandard.decompress(row["tokens"]), np.int32)
    begins = np.concatenate([[0], row["ends"][:-1]]).astype(np.int64)
    two = grams.combine(_shifted(words[tokens], begins, START), words[tokens])
    three = grams.combine(_shifted(two, begins, BEFORE), words[tokens])
    cut = np.uint64(64 - bits)
    return tokens, begins, words, two >> cut, three >> cut


def _shifted(x: np.ndarray, begins: np.ndarray, at_start) -> np.ndarray:
    """What stands before each token."""
    out = np.concatenate([x[:1], x[:-1]])
    out[begins] = at_start
    return out


SENT = "part long, sender long, both boolean, keys binary, counted binary, deleted binary"
ANSWER = "part long, sender long, both boolean, counted binary, training binary"
ORDER_AT = 48  # a part number is the order of its n-grams, then the first bits of their keys


def _messages(keys: np.ndarray, counted: np.ndarray, deleted: np.ndarray, order: int, taken: int, digits: int, bits: int):
    """Sorted keys that agree in the first ``taken`` bits, by the next ``digits`` bits."""
    prefix = keys >> np.uint64((64 if order == 1 else bits) - taken - digits) if taken + digits else np.zeros(len(keys), np.uint64)
    cuts = np.flatnonzero(np.diff(prefix)) + 1
    for k, c, d, p in zip(np.split(keys, cuts), np.split(counted, cuts), np.split(deleted, cuts), np.concatenate([prefix[:1], prefix[cuts]]), strict=True):
        yield (order << ORDER_AT) | int(p), k, c, d


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "sender", "both", "keys", "counted", "deleted"])


def _sent(batches, digits: int, bits: int):
    """Every chunk's distinct n-grams, by order and range of the hash space."""
    for row in _one_by_one(batches):
        tokens, _, words, two, three = _keys(row, bits)
        out = []
        for order, keys, times in ((1, words, np.bincount(tokens, minlength=len(words))), (2, *np.unique(two, return_counts=True)), (3, *np.unique(three, return_counts=True))):
            nothing = np.zeros(len(keys), np.int64)
            counted, deleted = (times if row["kind"] == kind else nothing for kind in (COUNTED, DELETED))
            for part, k, c, d in _messages(keys, counted, deleted, order, 0, digits, bits):
                out.append((part, row["chunk"], row["kind"] == DELETED, pack_keys(k), pack_counts(c), pack_counts(d)))
        yield _rows(out)


def _sent_on(batches, taken: int, digits: int, bits: int):
    """What a run sends to finer ranges."""
    for row in _one_by_one(batches):
        told = (unpack_keys(row["keys"]), unpack_counts(row["counted"]), unpack_counts(row["deleted"]))
        yield _rows([(part, row["run"], row["both"], pack_keys(k), pack_counts(c), pack_counts(d)) for part, k, c, d in _messages(*told, row["part"] >> ORDER_AT, taken, digits, bits)])


def _merge(rows: list[dict]):
    """Distinct keys of messages, their sums, and the place of every key sent."""
    keys = [unpack_keys(r["keys"]) for r in rows]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = []
    for name in ("counted", "deleted"):
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, at, np.concatenate([unpack_counts(r[name]) for r in rows]))
        sums.append(total)
    return distinct, *sums, np.split(at, np.cumsum([len(k) for k in keys])[:-1])


def _answers(rows: list[dict], places: list[np.ndarray], counted: np.ndarray, training: np.ndarray) -> list[dict]:
    return [{"part": r["part"], "sender": r["sender"], "both": r["both"], "counted": pack_counts(counted[at]) if r["both"] else None, "training": pack_counts(training[at])} for r, at in zip(rows, places, strict=True)]


_ANSWER = pa.schema([("part", pa.int64()), ("sender", pa.int64()), ("both", pa.bool_()), ("counted", pa.binary()), ("training", pa.binary())])
_SUMS = [("n", pa.int64()), ("v", pa.int64()), ("n_counted", pa.int64())]


def _added(table: pa.Table) -> pa.Table:
    """Totals of one range, sent back to each sender in its own order."""
    rows = table.to_pylist()
    _, counted, deleted, places = _merge(rows)
    training = counted + deleted
    out = _answers(rows, places, counted, training)
    sums = (int(training.sum()), int((training > 0).sum()), int(counted.sum())) if rows[0]["part"] >> ORDER_AT == 1 else (0, 0, 0)
    for i, r in enumerate(out):
        r.update(zip(("n", "v", "n_counted"), sums if i == 0 else (0, 0, 0), strict=True))
    return pa.Table.from_pylist(out, pa.schema([*_ANSWER, *_SUMS]))


def _merged(table: pa.Table) -> pa.Table:
    """The run of a group of senders."""
    rows = table.to_pylist()
    keys, counted, deleted, _ = _merge(rows)
    schema = pa.schema([("part", pa.int64()), ("grp", pa.int64()), ("both", pa.bool_()), ("keys", pa.binary()), ("counted", pa.binary()), ("deleted", pa.binary())])
    return pa.Table.from_pylist([{"part": rows[0]["part"], "grp": rows[0]["grp"], "both": any(r["both"] for r in rows), "keys": pack_keys(keys), "counted": pack_counts(counted), "deleted": pack_counts(deleted)}], schema)


def _returned(left: pa.Table, right: pa.Table) -> pa.Table:
    """A run with its totals from all finer ranges."""
    run, back = left.to_pylist()[0], sorted(right.to_pylist(), key=lambda r: r["part"])
    schema = pa.schema([("part", pa.int64()), ("grp", pa.int64()), ("keys", pa.binary()), ("counted", pa.binary()), ("training", pa.binary())])
    joined = {c: pack_counts(np.concatenate([unpack_counts(r[c]) for r in back])) if c == "training" or run["both"] else None for c in ("counted", "training")}
    return pa.Table.from_pylist([{"part": run["part"], "grp": run["grp"], "keys": run["keys"], **joined}], schema)


def _answered(left: pa.Table, right: pa.Table) -> pa.Table:
    """Totals of a run, sent back to each member of its group."""
    rows, run = left.to_pylist(), right.to_pylist()[0]
    keys, training = unpack_keys(run["keys"]), unpack_counts(run["training"])
    counted = unpack_counts(run["counted"]) if run["counted"] is not None else training
    return pa.Table.from_pylist(_answers(rows, [np.searchsorted(keys, unpack_keys(r["keys"])) for r in rows], counted, training), _ANSWER)


def total_counts(sent: DataFrame, senders: int, taken: int, part_bits: int, fan_bits: int, bits: int) -> tuple[DataFrame, tuple[int, int, int]]:
    """Answers to ``sent`` (see ``ANSWER``), and N, V and the words counted without the deleted."""
    if taken == part_bits:
        back = settle(sent.groupBy("part").applyInArrow(_added, f"{ANSWER}, n long, v long, n_counted long"), "counts")
        sums = back.agg(F.sum("n"), F.sum("v"), F.sum("n_counted")).first()
        return back.drop("n", "v", "n_counted"), tuple(int(x or 0) for x in sums)
    groups = math.ceil(senders / 2**fan_bits)
    sent = settle(sent.withColumn("grp", F.pmod(F.xxhash64("sender"), F.lit(groups))), "sent")
    merged = sent.groupBy("part", "grp").applyInArrow(_merged, "part long, grp long, both boolean, keys binary, counted binary, deleted binary")
    runs = settle(merged.withColumn("run", F.monotonically_increasing_id()), "runs")
    digits = min(fan_bits, part_bits - taken)
    finer = runs.mapInArrow(partial(_sent_on, taken=taken, digits=digits, bits=bits), SENT)
    back, sums = total_counts(finer, groups, taken + digits, part_bits, fan_bits, bits)
    told = runs.groupBy("run").cogroup(back.groupBy("sender")).applyInArrow(_returned, "part long, grp long, keys binary, counted binary, training binary")
    answers = sent.groupBy("part", "grp").cogroup(told.groupBy("part", "grp")).applyInArrow(_answered, ANSWER)
    return settle(answers, "answers"), sums


def _estimates(chunk: dict, back: list[dict], which: str, bits: int, n: int, starts: int):
    """Per token: the estimates of order 3, 2 and 1, the state of its context, and its word's count."""
    tokens, begins, _, two, three = _keys(chunk, bits)
    back = sorted(back, key=lambda r: r["part"])
    by = {order: np.concatenate([unpack_counts(r[which]) for r in back if r["part"] >> ORDER_AT == order]) for order in (1, 2, 3)}
    word = by[1][tokens].astype(np.float64)
    pair = by[2][np.unique(two, return_inverse=True)[1]].astype(np.float64)
    triple = by[3][np.unique(three, return_inverse=True)[1]].astype(np.float64)
    one, context = _shifted(word, begins, float(starts)), _shifted(pair, begins, float(starts))
    p = np.stack([_share(triple, context), _share(pair, one), word / n if n else np.zeros(len(word))])
    return p, np.where(context > 0, np.minimum(_levels(context), TOP), NEW + np.minimum(_levels(one), STATES - NEW - 1)), word


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0)


def _levels(context: np.ndarray) -> np.ndarray:
    """0 for a context not seen, else 1 + floor(log2(count))."""
    return np.frexp(context)[1].astype(np.int64)


CELLS = ("state", "three", "two", "one")
CELL_SCHEMA = pa.schema([(c, pa.int64()) for c in (*CELLS, "times", "sum_three", "sum_two", "sum_one")])


def _cells(left: pa.Table, right: pa.Table, bits: int, n: int, v: int, starts: int) -> pa.Table:
    """Histogram of what the deleted tokens' estimates are against uniform."""
    chunks = left.to_pylist()
    if not chunks or not n:
        return pa.Table.from_pylist([], CELL_SCHEMA)
    p, state, _ = _estimates(chunks[0], right.to_pylist(), "counted", bits, n, starts)
    with np.errstate(divide="ignore"):
        logs = np.log(p * (v + 1))
    bins = np.where(p > 0, np.round(np.where(p > 0, logs, 0) * STEPS), NONE).astype(np.int64)
    fine = np.where(p > 0, np.round(np.where(p > 0, logs, 0) * FINE), 0).astype(np.int64)
    cell = state
    for b in bins:
        cell = cell * 512 + (b + 256)
    cell, at, times = np.unique(cell, return_inverse=True, return_counts=True)
    sums = [np.bincount(at, f, len(cell)).astype(np.int64) for f in fine]
    told = [cell >> 27, *((cell >> s & 511) - 256 for s in (18, 9, 0)), times, *sums]
    return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in told], schema=CELL_SCHEMA)


def fit_mixture(cells: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights (order 3, 2, 1, uniform) by state of the context, by expectation maximisation.

    ``cells`` has rows of state, bins of the three estimates, times, and sums of their
    logarithms. A state without deleted tokens takes the weights of the one below.
    """
    mixture = np.zeros((STATES, 4))
    for state in range(STATES):
        own = cells[cells[:, 0] == state]
        start = [0.0, 0.0, 0.9, 0.1] if state in (0, NEW) else [0.0, 0.4, 0.5, 0.1] if state > NEW else [0.4, 0.3, 0.2, 0.1]
        if state in (0, 1, NEW, NEW + 1) or len(own):
            mixture[state] = start
        else:
            mixture[state] = mixture[state - 1]
        if not len(own):
            continue
        times = own[:, 4].astype(float)
        ratio = np.column_stack([np.where(own[:, 1:4] > NONE, np.exp(own[:, 5:8] / times[:, None] / FINE), 0.0), np.ones(len(own))])
        w = mixture[state]
        for _ in range(rounds):
            part = ratio * w
            part /= part.sum(axis=1, keepdims=True)
            w = (part * times[:, None]).sum(axis=0) / times.sum()
        mixture[state] = w
    mixture[:, 3] = np.maximum(mixture[:, 3], 1e-6)
    return mixture / mixture.sum(axis=1, keepdims=True)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(left: pa.Table, right: pa.Table, bits: int, n: int, v: int, starts: int, mixture: np.ndarray) -> pa.Table:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    chunks = left.to_pylist()
    if not chunks:
        return pa.Table.from_pylist([], schema)
    chunk = chunks[0]
    p, state, word = _estimates(chunk, right.to_pylist(), "training", bits, n, starts)
    base = np.log10((word + 0.1) / (n + 0.1 * (v + 1)))
    w = mixture[state].T if n else np.array([[0.0], [0.0], [0.0], [1.0]])
    score = np.log10((w[:3] * p).sum(axis=0) + w[3] / (v + 1))
    ends = np.asarray(chunk["ends"], np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    sums = [np.add.reduceat(x, begins) for x in ((word > 0).astype(np.int64), base, score)]
    m = len(ends)
    return pa.Table.from_arrays(
        [pa.array(chunk["docs"], pa.int64()), pa.array([chunk["kind"] == SCORED] * m), pa.array(ends - begins), pa.array(sums[0]), pa.array([n] * m, pa.int64()), pa.array(sums[1]), pa.array(sums[2])], schema=schema
    )


def score_texts(docs: DataFrame, *, folds: int = 10, chunk_tokens: int = 1_000_000, part_keys: int = 2_000_000, fan_bits: int = 8) -> DataFrame:
    """One row per row of ``docs``, see ``SCORES``.

    Fold 0 is scored only, fold 1 is deleted from the counts for fitting.
    A text longer than ``chunk_tokens`` makes one longer chunk.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), fold(F.col("doc_id"), folds).cast("int").alias("fold"))
    made = source.mapInArrow(partial(_chunked, chunk_tokens=chunk_tokens), "kind int, docs array<long>, ends array<long>, words binary, tokens binary, n long")
    chunks = settle(made.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    sizes = {r.kind: r for r in chunks.groupBy("kind").agg(F.sum("n").alias("n"), F.sum(F.size("docs")).alias("docs"), F.count(F.lit(1)).alias("chunks")).collect()}
    starts = sizes[COUNTED].docs if COUNTED in sizes else 0
    all_starts = starts + (sizes[DELETED].docs if DELETED in sizes else 0)
    tokens = sum(r.n for r in sizes.values())
    bits = min(64, max(32, tokens.bit_length() + 14))
    part_bits = max(0, math.ceil(math.log2(max(1, tokens / part_keys))))
    digits = min(fan_bits, part_bits)
    sent = chunks.mapInArrow(partial(_sent, digits=digits, bits=bits), SENT)
    answers, (n, v, counted) = total_counts(sent, sum(r.chunks for r in sizes.values()), digits, part_bits, fan_bits, bits)

    def meet(which: DataFrame, back: DataFrame, body, schema: str) -> DataFrame:
        return which.groupBy("chunk").cogroup(back.groupBy("sender")).applyInArrow(body, schema)

    cells = meet(chunks.where(F.col("kind") == DELETED), answers.where("both"), lambda a, b: _cells(a, b, bits, counted, v, starts), ", ".join(f"{c} long" for c in CELL_SCHEMA.names))
    found = cells.groupBy(*CELLS).agg(*(F.sum(c).alias(c) for c in CELL_SCHEMA.names[4:])).orderBy(*CELLS).toArrow()
    mixture = fit_mixture(np.stack([found[c].to_numpy() for c in CELL_SCHEMA.names], axis=1).reshape(-1, len(CELL_SCHEMA.names)))
    return meet(chunks, answers, lambda a, b: _scored(a, b, bits, n, v, all_starts, mixture), SCORES)
