"""Words of whole texts as numpy arrays: borders, and integer codes that are equal for equal words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemill.llm.common import text_bytes


def byte_class(separators: bytes) -> np.ndarray:
    """True for each byte value that belongs to words. Separators must be ASCII, so that they never
    are part of another character."""
    table = np.ones(256, bool)
    table[np.frombuffer(separators, np.uint8)] = False
    return table


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


class Words:
    """The words of a column of texts; row ``r`` has those from ``first[r]`` up to ``first[r + 1]``."""

    def __init__(self, column: pa.Array, in_word: np.ndarray, fold: np.ndarray | None = None):
        self.data, self.offsets = text_bytes(column)
        if fold is not None:
            self.data = fold[self.data]
        self.inside = in_word[self.data]
        begins, ends = self.inside.copy(), self.inside.copy()
        begins[1:] &= ~self.inside[:-1]
        ends[:-1] &= ~self.inside[1:]
        borders = self.offsets[:-1][np.diff(self.offsets) > 0]
        begins[borders] = self.inside[borders]
        ends[borders[borders > 0] - 1] = self.inside[borders[borders > 0] - 1]
        self.begin, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.begin, self.offsets)

    def __len__(self) -> int:
        return len(self.begin)

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """A code for each word and the words in the order of their codes."""
        ends = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.end - self.begin, out=ends[1:])
        flat = self.data[self.inside]
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(flat)]
        words = pa.Array.from_buffers(pa.large_binary(), len(self), buffers).dictionary_encode()
        return words.indices.to_numpy(), words.dictionary


def pieces(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text; a longer text is a range of its own."""
    _, offsets = text_bytes(texts)
    start = 0
    while start < len(texts):
        room = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = max(start + 1, min(room, len(texts)))
        yield start, stop
        start = stop
