"""Walking many token sequences side by side, a numpy operation for each step of all of them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
# Texts that are walked together; a longer one is walked alone.
TOGETHER_BYTES = 12 << 20


class Numbers(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def slices(batches: Iterator[pa.RecordBatch], text: int, together: int = TOGETHER_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of batches whose texts (a binary column) have about ``together`` bytes."""
    for batch in batches:
        sizes = np.array([0 if v.as_py() is None else len(v.as_buffer()) for v in batch.column(text)], np.int64)
        first = 0
        while first < batch.num_rows:
            last, size = first + 1, sizes[first]
            while last < batch.num_rows and size + sizes[last] <= together:
                size += sizes[last]
                last += 1
            yield batch.slice(first, last - first)
            first = last


def numbered_words(texts: pa.Array, end: bytes | None = None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word numbers of all texts in a row, words per text, and the distinct words; ``end`` closes every text."""
    numbers, parts, sizes = Numbers(), [], []
    closing = [] if end is None else [end]
    for value in texts:
        text = value.as_py()
        words = (WORD.findall(text.lower()) if text else []) + closing
        sizes.append(len(words))
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), np.array(sizes, np.int64), list(numbers)


class Lanes:
    """Sequences ordered by falling length, so those still running are always the first ones."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
        self.begins = begins[self.order].astype(np.int64)
        self.sizes = sizes[self.order]
        longest = int(self.sizes[0]) if len(sizes) else 0
        self.running = np.searchsorted(-self.sizes, -np.arange(longest), side="left")

    def __iter__(self) -> Iterator[np.ndarray]:
        """Positions of the t-th token of every sequence that has one, t rising."""
        for t, active in enumerate(self.running):
            yield self.begins[:active] + t

    def backward(self) -> Iterator[np.ndarray]:
        for t in range(len(self.running) - 1, -1, -1):
            yield self.begins[: self.running[t]] + t
