"""Vectorised byte work inside tasks: words, hashes and runs of many documents at once.

Texts of an Arrow batch lie end to end in one buffer. The functions below find words, hash them
and hash their n-grams for a chunk of documents with a few numpy passes; no function keeps more
than one chunk, whose size is bounded except where a single document is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
U = np.uint64

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: A fixed odd base and a fixed random-looking value per byte.
BASE = U(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (shift and multiply rounds)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE = mixed(np.arange(1, 257, dtype=U) * BASE)


def powers(n: int) -> np.ndarray:
    """BASE to the powers 0 to n-1, modulo 2**64."""
    out = np.full(max(n, 1), BASE, U)
    out[0] = U(1)
    return np.multiply.accumulate(out)


@dataclass
class Chunk:
    """Documents first..first+n-1 of a batch; ``starts`` are their offsets in ``data``."""

    first: int
    data: np.ndarray
    starts: np.ndarray

    @property
    def n(self) -> int:
        return len(self.starts) - 1


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column into chunks of about ``size`` bytes; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield Chunk(i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


@dataclass
class Words:
    """Words of a chunk: byte ranges, hashes, and the first word of every document."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # n + 1 offsets into the word arrays

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(chunk: Chunk, split: np.ndarray = WHITE, fold: np.ndarray | None = LOWER) -> Words:
    """Maximal runs of bytes outside ``split``; ``fold`` maps bytes before hashing."""
    data = chunk.data
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, U), np.zeros(chunk.n + 1, np.int64))
    inside = ~split[data]
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    borders = chunk.starts[:-1]
    borders = borders[borders < len(data)]
    head[borders] = inside[borders]
    tail = inside.copy()
    tail[:-1] &= ~inside[1:]
    tail[borders[borders > 0] - 1] = inside[borders[borders > 0] - 1]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    first = np.searchsorted(start, chunk.starts)
    if len(start) == 0:
        return Words(start, end, np.zeros(0, U), first)
    at = np.flatnonzero(inside)
    lengths = end - start
    word_at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(at)) - np.repeat(word_at, lengths)
    letters = data[at] if fold is None else fold[data[at]]
    terms = BYTE[letters] * powers(int(lengths.max()))[place]
    return Words(start, end, mixed(np.add.reduceat(terms, word_at) + lengths.astype(U)), first)


def grams(w: Words, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one document, and the offsets of each document's.

    With ``short``, a document of fewer than n words (at least one) has its whole sequence as one.
    """
    count = np.diff(w.first)
    total = len(w.hash)
    weights = powers(n + 1)
    if total >= n:
        h = np.zeros(total - n + 1, U)
        for k in range(n):
            h += w.hash[k:total - n + 1 + k] * weights[n - k]
        keep = np.ones(total - n + 1, bool)
        for k in range(1, n):  # windows that begin among a document's last n-1 words
            cut = w.first[1:] - k
            keep[cut[(cut >= 0) & (cut < len(keep))]] = False
        h = mixed(h[keep])
    else:
        h = np.zeros(0, U)
    have = np.maximum(count - n + 1, 0)
    if not short or not ((count > 0) & (count < n)).any():
        return h, np.concatenate(([0], np.cumsum(have)))
    less = (count > 0) & (count < n)
    offsets = np.concatenate(([0], np.cumsum(np.where(less, 1, have))))
    out = np.zeros(offsets[-1], U)
    whole = np.zeros(offsets[-1], bool)
    whole[offsets[:-1][less]] = True
    out[~whole] = h
    for d in np.flatnonzero(less):
        own = w.hash[w.first[d]:w.first[d + 1]]
        out[offsets[d]] = mixed(np.array([(own * weights[1:len(own) + 1]).sum(dtype=U)
                                          + U(len(own))]))[0]
    return out, offsets


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document, and their offsets."""
    parts, sizes = [], np.zeros(len(offsets), np.int64)
    for d in range(len(offsets) - 1):
        own = np.sort(values[offsets[d]:offsets[d + 1]])
        if len(own) > 1:
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        parts.append(own)
        sizes[d + 1] = len(own)
    return (np.concatenate(parts) if parts else values[:0]), np.cumsum(sizes)


def repeated(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mark the values that occur twice or more within their document."""
    doc = np.repeat(np.arange(1, len(offsets), dtype=U), np.diff(offsets))
    own = mixed(values + doc * BASE)
    order = np.sort(own)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
    return twice[at] == own


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each document's values."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.Array:
    """An Arrow list column from flat values."""
    flat = values.view(np.int64) if values.dtype == U else values
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, kind))
