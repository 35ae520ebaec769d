"""Words of whole Arrow text batches as numpy arrays, without a Python string per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; bounds the arrays below, not the texts.
SLICE_BYTES = 2 << 20

# White space is \x20 and \x09-\x0D; every other byte belongs to a word.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


@dataclass
class Slice:
    """Some neighbouring rows: their UTF-8 bytes and ``offsets`` (rows + 1) into them."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Every word of a slice: byte range, row and 64-bit hash of its bytes."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Consecutive rows of at most ``limit`` bytes (one row at least); null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    _, bounds, values = texts.buffers()
    offsets = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        own = offsets[at : to + 1]
        yield Slice(at, data[own[0] : own[-1]], own - own[0])
        at = to


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values in each row's range."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit (the public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range; the ranges are ascending and do not overlap."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    powers = np.ones(int(length.max()) + 1, np.uint64)
    np.cumprod(np.full(len(powers) - 1, _BASE), out=powers[1:])
    first = np.zeros(len(start), np.int64)
    np.cumsum(length[:-1], out=first[1:])
    within = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
    values = _BYTE_VALUES[data[within + np.repeat(start, length)]] * powers[within]
    filled = length > 0
    sums = np.zeros(len(start), np.uint64)
    if filled.any():
        sums[filled] = np.add.reduceat(values, first[filled])
    return mixed(sums + length.astype(np.uint64))


def words_of(part: Slice, hashes: bool = True) -> Words:
    """The words of every row, in order."""
    inside = ~_SPACE[part.data]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    filled = part.offsets[1:] > part.offsets[:-1]
    before[part.offsets[:-1][filled]] = False
    after[part.offsets[1:][filled] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(part.offsets, start, "right") - 1
    # Empty rows share their offset with the next one; "right" picks the last, which has the text.
    return Words(start, end, row, range_hashes(part.data, start, end) if hashes else np.zeros(0, np.uint64))


def window_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of ``width`` words within one row."""
    n = len(words.start) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(words.row[:n] == words.row[width - 1 :])
    total = np.zeros(len(first), np.uint64)
    for k in range(width):
        total = mixed(total + words.hash[first + k] * np.uint64(2 * k + 1))
    return first, total


def shingles(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every ``width``-word shingle; a shorter text has one of all its words."""
    words = words_of(part)
    first, hashed = window_hashes(words, width)
    count = np.bincount(words.row, minlength=part.rows)
    begin = np.zeros(part.rows, np.int64)
    np.cumsum(count[:-1], out=begin[1:])
    rows, extra = [words.row[first]], [hashed]
    for size in range(1, width):  # the short texts
        own = np.flatnonzero(count == size)
        total = np.full(len(own), size + 1000, np.uint64)
        for k in range(size):
            total = mixed(total + words.hash[begin[own] + k] * np.uint64(2 * k + 1))
        rows.append(own)
        extra.append(total)
    return np.concatenate(rows), np.concatenate(extra)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [x or "" for x in column.to_pylist()]


def unused_names(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores in front until no column has it (letter case ignored)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out
