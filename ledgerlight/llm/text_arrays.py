"""Words, lines and their hashes for a batch of texts, as whole numpy arrays.

Texts come as Arrow string arrays; the work runs on their UTF-8 bytes in blocks
of a few megabytes, so memory stays bounded whatever the batch or a text holds.
All patterns in use treat bytes from 0x80 on as word characters, and lower only
A to Z, so bytes give the same words as code points.

Hashes are 64 bits: powers of a fixed odd number over the bytes or words of a
span, summed modulo 2**64 and mixed. A span's hash is a difference of two
prefix sums, so a window of any length costs the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Bytes between words: of the pattern [^\x20\x09-\x0D]+ and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[0x0A] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64, in place on a copy."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    """A random number for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


class _Powers:
    """Powers of the odd number and of its inverse, grown on demand."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)
    inverse = pow(_ODD, -1, 1 << 64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            k = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * np.uint64(pow(_ODD, k, 1 << 64))])
            cls.down = np.concatenate([cls.down, cls.down * np.uint64(pow(cls.inverse, k, 1 << 64))])
        return cls.up[:n], cls.down[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Weighted sums of the first 0, 1, 2 ... values."""
    up, _ = _Powers.upto(len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end); equal spans hash equally wherever they stand."""
    _, down = _Powers.upto(len(sums) + 1)
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


class Block:
    """Neighbouring texts of a batch: their bytes and where each text begins and ends."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray) -> None:
        self.first, self.data, self.bounds = first, data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> Block:
        return Block(self.first, LOWER[self.data], self.bounds)

    def spans(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words in bytes, and each text's first word (one more at the end)."""
        inside = ~separators[self.data]
        n = len(inside)
        before = np.zeros(n, dtype=bool)
        before[1:] = inside[:-1]
        edges = self.bounds[:-1]
        before[edges[edges < n]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(n, dtype=bool)
        after[:-1] = inside[1:]
        edges = self.bounds[1:] - 1
        after[edges[edges >= 0]] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return span_hashes(prefix_sums(byte_values()[self.data]), starts, ends)


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts in order, a few megabytes at a time; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + block_bytes, side="right")) - 1)
        yield Block(a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        a = b


def owner(first: np.ndarray) -> np.ndarray:
    """The text of each word, from the texts' first words."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which k consecutive words of one text begin, and those windows' hashes."""
    last = np.repeat(first[1:], np.diff(first))
    starts = np.flatnonzero(np.arange(len(words)) + k <= last)
    return starts, span_hashes(prefix_sums(words), starts, starts + k)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list per text from values in order."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
