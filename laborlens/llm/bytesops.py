"""Vectorised work on the bytes of many documents at once, used inside Arrow tasks.

Documents of a batch are joined into one buffer of bounded size, so that numpy works on a few large arrays
instead of many small ones. A document longer than the bound makes a buffer of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text in a buffer, unless one document alone is longer.
BUFFER = 1 << 20

_M = (1 << 64) - 1
#: An odd multiplier of the polynomial hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_rng = np.random.RandomState(20240607)
#: A random 64-bit value for each byte.
BYTE_VALUE = _rng.randint(0, 1 << 62, 256).astype(np.uint64) * np.uint64(4) + _rng.randint(0, 4, 256).astype(np.uint64)

#: Bytes that separate words: space, tab to carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Powers:
    """Powers of the multiplier and of its inverse, as long as the longest buffer seen so far needs."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, BUFFER + BUFFER // 4)
            out = []
            for base in (_BASE, _INVERSE):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                out.append(np.multiply.accumulate(p))
            if size > 8 * BUFFER:  # of one very long text: not kept
                return out[0][:n], out[1][:n]
            cls.up, cls.down = out
        return cls.up[:n], cls.down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Prefix:
    """Hashes of any span of a buffer in constant time."""

    def __init__(self, data: np.ndarray):
        up, down = _Powers.of(len(data) + 1)
        self.up = up
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        terms = BYTE_VALUE[data]
        terms *= down[: len(data)]
        np.cumsum(terms, out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes [start, end); equal bytes have equal hashes wherever they stand."""
        length = (end - start).astype(np.uint64)
        # Undo the position: the sum of value * inverse**i times multiplier**start.
        return mix((self.sums[end] - self.sums[start]) * self.up[start] + length * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all windows of one size, not mixed with the length."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:n]) * self.up[:n])


class Docs:
    """Some documents in one buffer, each followed by one separating space."""

    def __init__(self, rows: pa.RecordBatch, texts: list[bytes]):
        self.rows, self.texts = rows, texts
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.zeros(len(texts), np.int64)
        np.cumsum(self.lengths[:-1] + 1, out=self.starts[1:])
        self.ends = self.starts + self.lengths

    def __len__(self) -> int:
        return len(self.texts)

    def joined(self, lower: bool = False) -> np.ndarray:
        data = b" ".join(self.texts)
        return np.frombuffer((data.lower() if lower else data) + b" ", np.uint8)


def documents(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BUFFER) -> Iterator[Docs]:
    """Cut the batches of a task into groups of documents of at most ``limit`` bytes; null text is empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        begin, size, texts = 0, 0, []
        for i, value in enumerate(column.cast(pa.binary())):
            value = value.as_py() or b""
            if texts and size + len(value) > limit:
                yield Docs(batch.slice(begin, i - begin), texts)
                begin, size, texts = i, 0, []
            texts.append(value)
            size += len(value)
        if texts:
            yield Docs(batch.slice(begin), texts)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are no white space."""
    solid = np.empty(len(data) + 2, bool)
    solid[0] = solid[-1] = False
    np.logical_not(IS_SPACE[data], out=solid[1:-1])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    return edge[0::2], edge[1::2]


def per_document(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` by document, as long."""
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64) if len(owner) else np.zeros(n, np.int64)


def count_by_document(marks: np.ndarray, docs: Docs) -> np.ndarray:
    """Number of marked bytes in each document."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[docs.ends] - sums[docs.starts]


def as_signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
