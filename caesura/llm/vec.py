"""Words, lines and shingles of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a maximal run of bytes other than space and 0x09-0x0D, so no decoding is needed. Hashes are
64-bit polynomial hashes of byte ranges, each byte having a random odd multiplier table entry, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from caesura.llm.memory import give_back

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64
_BYTE = np.random.RandomState(20).randint(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = U(_BASE)
_BACK = U(pow(_BASE, -1, 2**64))
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, step in enumerate((_STEP, _BACK)):
            grown = np.full(n, step, U)
            grown[0] = 1
            _powers[k] = np.cumprod(grown)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Ranges:
    """Hashes of any ranges of the bytes b."""

    def __init__(self, b: np.ndarray):
        up, self.down = powers(len(b) + 1)
        self.sums = np.zeros(len(b) + 1, U)
        np.cumsum(_BYTE[b] * up[:-1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = self.sums[end] - self.sums[start]
        x *= self.down[start]
        return mix(x + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


class Chunk:
    """Texts laid end to end: b their bytes, edge the n + 1 offsets of their ends."""

    def __init__(self, b: np.ndarray, edge: np.ndarray):
        self.b, self.edge, self.n = b, edge, len(edge) - 1

    def words(self, lower: bool = True, gap: np.ndarray = SPACE) -> None:
        """Sets start, end, doc (index of the text), hash by word and first (n + 1 offsets into the words)."""
        solid = ~gap[self.b]
        cut = np.zeros(len(self.b) + 1, bool)
        cut[self.edge] = True
        left, right = solid.copy(), solid.copy()
        left[1:] &= ~solid[:-1] | cut[1:-1]
        right[:-1] &= ~solid[1:] | cut[1:-1]
        self.start, self.end = np.flatnonzero(left), np.flatnonzero(right) + 1
        self.first = np.searchsorted(self.start, self.edge)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))
        self.solid = solid
        self.hash = Ranges(LOWER[self.b] if lower else self.b).hash(self.start, self.end)

    def raw(self) -> np.ndarray:
        """Hashes of the words as they stand."""
        return Ranges(self.b).hash(self.start, self.end)

    def shingles(self, k: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-word windows inside texts, and the n + 1 offsets of the texts' windows.

        short: a text of 1 to k - 1 words has one window, all its words.
        """
        size = np.diff(self.first)
        count = np.maximum(size - k + 1, (short & (size > 0)).astype(np.int64))
        at = np.zeros(self.n + 1, np.int64)
        np.cumsum(count, out=at[1:])
        pos = np.arange(at[-1]) + np.repeat(self.first[:-1] - at[:-1], count)
        last = np.repeat(self.first[1:], count)
        h = np.zeros(at[-1], U)
        for j in range(k):
            inside = pos + j < last
            h = h * U(0x9FB21C651E98DF25) + np.where(inside, self.hash[np.minimum(pos + j, max(len(self.hash) - 1, 0))], U(j + 1)) if len(h) else h
            h ^= h >> U(29)
        return mix(h), at

    def total(self, flags: np.ndarray, edge: np.ndarray | None = None) -> np.ndarray:
        """Sums of flags by text (or between the edges given)."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        edge = self.edge if edge is None else edge
        return sums[edge[1:]] - sums[edge[:-1]]


def chunks(texts: pa.Array, size: int = 1_000_000) -> Iterator[tuple[int, int, Chunk]]:
    """(from, to, Chunk) over an Arrow string column, about size bytes each; a null counts as empty. A longer text comes alone."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    edge = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    b = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(edge, edge[i] + size, "right")) - 1)
        yield i, j, Chunk(b[edge[i] : edge[j]], edge[i : j + 1] - edge[i])
        i = j
    give_back()
