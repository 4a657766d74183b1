"""Hashed words and shingles of whole texts, as numpy arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hashes by word; the memory is bounded by emptying it when full."""

    def __init__(self, most: int = 150_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased (bytes know no other case)."""
    return text.lower().split() if text else []


def word_hashes(parts: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))


def combine(a: np.ndarray, b) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a * _A + b
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


def ngrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; a shorter text is one run of its length."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    x = combine(hashes[:n], np.uint64(k))
    for j in range(1, k):
        x = combine(x, hashes[j : n + j])
    return x


def set_digest(shingles: np.ndarray) -> bytes:
    """128 bits that name a sorted set of hashes."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches, column by column turned into Python values."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)
