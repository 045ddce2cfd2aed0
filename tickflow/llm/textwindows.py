"""Word and window hashes of many texts at once, in numpy, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hash of a word (bytes), kept for words seen lately."""

    def __init__(self, seed: int = 0, most: int = 300_000):
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return out


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, empty for null. bytes.split() splits at exactly the six ASCII separators."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def in_chunks(texts: list[bytes], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes together, one text at least."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > most:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def hashed(texts: list[bytes], words: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in turn, and the number of words of each text."""
    parts = [np.fromiter(map(words.__getitem__, w), np.uint64, len(w)) for w in (t.split() for t in texts)]
    counts = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), counts


def window_hashes(words: np.ndarray, k: int, at: np.ndarray | None = None) -> np.ndarray:
    """The hash of each k consecutive words, or of those that start ``at`` (also across texts: mask those by the texts' bounds)."""
    n = max(0, len(words) - k + 1) if at is None else len(at)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _MULTIPLIER + (words[j:j + n] if at is None else words[at + j])
    h ^= h >> np.uint64(29)
    h *= _FINAL
    h ^= h >> np.uint64(32)
    return h


def text_numbers(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the number of its text and its position there."""
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.empty(0, np.int64)
    return text, np.arange(len(text)) - start[text]
