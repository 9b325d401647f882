"""Words of whole batches of texts as numpy arrays, for operators that hash them.

Arrow hands Python the UTF-8 bytes of many texts in one buffer.  Words are found
and hashed over that buffer at once, never text by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once, but for longer single texts.
PIECE_BYTES = 1 << 20


def byte_table(separators: bytes) -> np.ndarray:
    """What each byte becomes: 0 for separators, lower case for A-Z, itself otherwise."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a lower-cased text: ASCII letters and digits and all above ASCII.
ALPHANUMERIC = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Words ``[^\x20\x09-\x0D]+``, between white space.
SPACED = byte_table(b"\t\n\x0b\x0c\r ")


def pieces(batch: pa.RecordBatch, *columns: int, limit: int = PIECE_BYTES, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``rows`` whole rows with at most ``limit`` bytes of text in the columns, or one row."""
    sizes = [pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False) for c in columns]
    ends = np.cumsum(np.sum(sizes, axis=0, dtype=np.int64))
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        stop = min(max(at + 1, int(np.searchsorted(ends, done + limit, side="right"))), at + rows)
        yield batch.slice(at, stop - at)
        at = stop


@cache
def _byte_marks() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**64, 256, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a one-to-one map."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15


class Words:
    """The words of an Arrow array of texts: where they stand, whose they are, and their hashes."""

    def __init__(self, texts: pa.Array, table: np.ndarray):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, values = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(values, np.uint8)[bounds[0] : bounds[-1]] if values is not None else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        self.data = table[data]
        inside = self.data != 0
        edge = np.zeros(len(data) + 1, bool)  # where a text begins or the data ends
        edge[bounds] = True
        before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.concatenate([inside[1:], [False]]) if len(data) else inside
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(bounds, self.start, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(texts))
        self._inside = inside

    def hashes(self, limit: int = 2 * PIECE_BYTES) -> np.ndarray:
        """A 64-bit hash of every word's bytes; about ``limit`` bytes are worked on at once."""
        lengths = self.end - self.start
        result = np.zeros(len(lengths), np.uint64)
        if not len(lengths):
            return result
        marks, content, ends = _byte_marks(), self.data[self._inside], np.cumsum(lengths)
        powers = np.cumprod(np.full(int(lengths.max()), np.uint64(_BASE)))
        at = 0
        while at < len(lengths):
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            here = lengths[at:stop]
            first = np.cumsum(here) - here
            place = np.arange(int(here.sum())) - np.repeat(first, here)
            part = content[done : int(ends[stop - 1])]
            result[at:stop] = mixed(np.add.reduceat(marks[part] * powers[place], first))
            at = stop
        return result

    def text(self, first: int, last: int) -> str:
        """Words ``first`` to ``last - 1``, which lie in one text, with single spaces."""
        return " ".join(self.data[a:b].tobytes().decode() for a, b in zip(self.start[first:last], self.end[first:last], strict=True))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` words in a row, at their first word; also across texts."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = _BASE
    for j in range(k):
        total += hashes[j : j + n] * np.uint64(factor)
        factor = (factor * _BASE + 2 * j + 2) % 2**64
    return mixed(total)


def grams_at(hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """What :func:`gram_hashes` has at the places ``at``."""
    total = np.zeros(len(at), np.uint64)
    factor = _BASE
    for j in range(k):
        total += hashes[at + j] * np.uint64(factor)
        factor = (factor * _BASE + 2 * j + 2) % 2**64
    return mixed(total)
