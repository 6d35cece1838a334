"""Word-level helpers that work on whole Arrow batches."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A word is a maximal run of Unicode letters and digits.
WORD = re.compile(r"[^\W_]+")
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def pieces(batch: pa.RecordBatch, texts: list[int], rows: int = 2_500, size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``rows`` rows and about ``size`` bytes in its text columns; a longer text is a slice of its own."""
    lengths = sum(pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for i in texts)
    upto, at = np.cumsum(lengths), 0
    while at < len(batch):
        before = upto[at - 1] if at else 0
        end = max(at + 1, min(at + rows, int(np.searchsorted(upto, before + size, "right"))))
        yield batch.slice(at, end - at)
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: nearby integers become unrelated ones."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Coded:
    """The words of many texts as one code array; text i has the codes start[i]:start[i + 1]."""

    def __init__(self, texts: list[str | None], word: re.Pattern[str] = WORD) -> None:
        book: dict[str, int] = defaultdict()
        book.default_factory = book.__len__
        words: list[str] = []
        start = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                words += word.findall(text.lower())
            start[i + 1] = len(words)
        self.codes = np.fromiter(map(book.__getitem__, words), np.int64, len(words))
        self.start, self.words = start, list(book)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


def windows(values: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` values that stay within one text, and the place each starts at."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    mixed = mix(values + 1)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + mixed[k : n + k]
    owner = np.repeat(np.arange(len(start) - 1), np.diff(start))
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mix(h[at]), at
