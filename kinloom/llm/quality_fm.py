"""Quality classifier: a factorisation machine over words, structure and metadata.

Features of a text: its distinct words hashed to ``2 ** BITS`` slots (their values
make a vector of length 1), and one indicator each for the bin of every structure
statistic and of the length on record. The score is

``sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))``

so all pairs interact through ``FACTORS`` numbers per feature, in linear time.

Fitting takes the first ``max_train`` labelled ids by a hash of the id, one text each, as long as
they have ``max_values`` features together; only these features (4 bytes each) reach the driver.
Every document is scored where it lies: nothing moves, and the model has a fixed size.

Defined cases: a null or empty text has structure features only and gets a score
like others; a null id is in fold 0 (held out); rows with equal ids are scored one by
one, and the least of their texts is learned; an empty table gives no rows; texts may have any length; extra columns are
ignored, whatever their names; null labels and labels without a document are not learned; without labels
every score is 0.5. Language, source and id are no features.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinloom.llm.common import fold, ship

BITS, FACTORS, BINS = 15, 8, 16
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>!"
_STOPS = b".,;:?"
STATISTICS = 11
SIZE = (1 << BITS) + STATISTICS * BINS


def _share(part: float, whole: float) -> int:
    """Bin of a share: 0 for none, then by halves from the whole down."""
    if not part or not whole:
        return 0
    return max(1, BINS - 1 - int(-2 * math.log2(min(1.0, part / whole))))


def _size(n: float) -> int:
    return min(BINS - 1, int(math.log2(n + 1)))


def statistics(data: bytes, parts: list[bytes], distinct: int, on_record: int | None) -> list[int]:
    """Bins of the structure statistics and of the length on record."""
    n, size = len(parts), len(data)
    without = lambda chars: size - len(data.translate(None, chars))
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = without(_LETTERS)
    most = max((len(x) for x in lines), default=0)
    return [
        _size(n),
        _share(without(_SYMBOLS), size),
        _share(without(_UPPER), letters),
        _share(without(_DIGITS), size),
        _share(n - distinct, n),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(without(_STOPS), size),
        min(BINS - 1, int(2 * letters / n)) if n else 0,
        _size(len(lines)),
        _size(most),
        _size(max(0, on_record)) if on_record is not None else BINS - 1,
    ]


class Slots(dict):
    """Slots by word; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        self[word] = slot = zlib.crc32(word) & ((1 << BITS) - 1)
        return slot


class Features:
    """Feature numbers and values of a text."""

    def __init__(self):
        self.slots = Slots()

    def __call__(self, text: bytes | None, on_record: int | None) -> tuple[np.ndarray, np.ndarray]:
        data = text or b""
        parts = data.split()
        own = set(parts)
        hashed = sorted(set(map(self.slots.__getitem__, own)))
        bins = [(1 << BITS) + BINS * i + b for i, b in enumerate(statistics(data, parts, len(own), on_record))]
        at = np.array(hashed + bins, np.int64)
        return at, values_of(at)


class Machine:
    """Weights; raw scores by the sum-of-squares identity."""

    def __init__(self, seed: int = 7):
        self.w0 = 0.0
        self.w = np.zeros(SIZE)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (SIZE, FACTORS))

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.v[at] * x[:, None]
        return float(self.w0 + self.w[at] @ x + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v * v).sum()))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> None:
        """Logistic loss, AdaGrad over seeded batches, in one thread."""
        if not rows:
            self.v[:] = 0
            return
        g0, gw, gv = 1e-6, np.full(SIZE, 1e-6), np.full((SIZE, FACTORS), 1e-6)
        draw = np.random.default_rng(seed)
        for _ in range(epochs):
            for own in np.array_split(draw.permutation(len(rows)), max(1, len(rows) // batch)):
                at = np.concatenate([rows[i][0] for i in own])
                x = np.concatenate([rows[i][1] for i in own])
                of = np.repeat(np.arange(len(own)), [len(rows[i][0]) for i in own])
                starts = np.searchsorted(of, np.arange(len(own)))
                v = self.v[at] * x[:, None]
                s = np.add.reduceat(v, starts)
                raw = self.w0 + np.add.reduceat(self.w[at] * x, starts) + 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((v * v).sum(axis=1), starts))
                err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[own]) / len(own)
                hit, back = np.unique(at, return_inverse=True)
                dw = np.bincount(back, err[of] * x) + decay * self.w[hit] / len(rows) * len(own)
                dv = (err[of] * x)[:, None] * (s[of] - v)
                dv = np.stack([np.bincount(back, dv[:, f]) for f in range(FACTORS)], axis=1) + decay * self.v[hit]
                d0 = err.sum()
                g0 += d0 * d0
                self.w0 -= rate * d0 / math.sqrt(g0)
                gw[hit] += dw * dw
                self.w[hit] -= rate * dw / np.sqrt(gw[hit])
                gv[hit] += dv * dv
                self.v[hit] -= rate * dv / np.sqrt(gv[hit])


def _columns(docs: DataFrame) -> DataFrame:
    on_record = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), on_record.alias("n_chars"))


def values_of(at: np.ndarray) -> np.ndarray:
    """Feature values by the feature numbers: words share a length of 1."""
    word = at < 1 << BITS
    return np.where(word, 1 / math.sqrt(max(1, int(word.sum()))), 1.0)


def _featured(batches):
    make = Features()
    for batch in batches:
        rows = [make(t, n)[0].astype(np.int32) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), batch.column("draw"), batch.column("doc_id").cast(pa.int64()), pa.array(rows, pa.list_(pa.int32())), pa.array([len(r) for r in rows], pa.int64())], ["label", "draw", "doc_id", "at", "n"])


def fit_machine(docs: DataFrame, labels: DataFrame, *, folds: int = 5, max_train: int = 6000, max_values: int = 20_000_000) -> Machine:
    """The machine fitted to labelled rows outside fold 0."""
    ship(docs.sparkSession)
    usable = labels.where("doc_id is not null and quality in (0, 1)").where(fold(F.col("doc_id"), folds) != 0)
    one = usable.groupBy("doc_id").agg(F.max("quality").alias("label"))
    chosen = one.withColumn("draw", F.xxhash64("doc_id")).orderBy("draw", "doc_id").limit(max_train)
    least = _columns(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "draw").agg(F.min(F.struct("text", "n_chars")).alias("t"))
    rows = least.select("doc_id", "label", "draw", "t.text", "t.n_chars").mapInArrow(_featured, "label int, draw long, doc_id long, at array<int>, n long")
    so_far = Window.partitionBy(F.lit(0)).orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # max_train rows at most
    found = rows.withColumn("_sum", F.sum("n").over(so_far)).where(F.col("_sum") <= max_values).select("draw", "doc_id", "label", "at").toArrow().sort_by([("draw", "ascending"), ("doc_id", "ascending")])
    machine = Machine()
    at = [np.asarray(x.values, np.int64) for x in found["at"]]
    machine.fit([(x, values_of(x)) for x in at], found["label"].to_numpy().astype(float))
    return machine


def score_quality(docs: DataFrame, machine: Machine, *, folds: int = 5, least: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def scored(batches):
        make, m = Features(), model.value
        for batch in batches:
            raw = np.array([m.raw(*make(t, n)) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)])
            score = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= least).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = _columns(docs).withColumn("held_out", fold(F.col("doc_id"), folds) == 0)
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")
