"""Words and rolling hashes over whole Arrow text columns, in numpy inside Spark tasks.

A word is a maximal run of bytes other than space and 0x09-0x0D. Everything
works on the UTF-8 buffer of a batch, a few megabytes of documents at a time,
so memory follows the longest document and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer on unsigned 64-bit values."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def byte_codes(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, _U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=_U))
        return self.up[:n], self.down[:n]


#: Fixed odd multipliers; two independent families.
BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
POWERS = tuple(Powers(b) for b in BASES)
CODES = tuple(byte_codes(s) for s in (1, 2))


def rolling(values: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """A hash of every ``width`` consecutive values; empty if there are fewer."""
    n = len(values)
    if n < width:
        return np.zeros(0, _U)
    up, down = POWERS[family].get(n)
    total = np.zeros(n + 1, _U)
    np.cumsum(values * up, out=total[1:])
    return mix((total[width:] - total[: n - width + 1]) * down[: n - width + 1])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), offsets.astype(np.int64)


def chunks(column: pa.Array, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of about ``size`` bytes each, ``CHUNK_BYTES`` if none is given."""
    size = CHUNK_BYTES if size is None else size
    data, offsets = text_buffer(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def hashes(data: np.ndarray, offsets: np.ndarray, family: int = 0) -> np.ndarray:
    """A hash of each run of bytes between two offsets; no run is empty."""
    if len(offsets) < 2:
        return np.zeros(0, _U)
    data, begin, lens = data[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0], np.diff(offsets)
    place = np.arange(int(lens.sum())) - np.repeat(begin, lens)
    up, _ = POWERS[family].get(int(lens.max()))
    return mix(np.add.reduceat(CODES[family][data] * up[place], begin) + lens.astype(_U))


class Words:
    """Words of a chunk: byte spans, the row each lies in, and the first word of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        solid = ~SEPARATOR[data]
        n = len(data)
        open_, close = np.ones(n, bool), np.ones(n, bool)
        if n:
            open_[1:] = ~solid[:-1]
            open_[offsets[:-1][offsets[:-1] < n]] = True
            close[:-1] = ~solid[1:]
            ends = offsets[1:]
            close[ends[ends > 0] - 1] = True
        self.solid = solid
        self.starts = np.flatnonzero(solid & open_)
        self.ends = np.flatnonzero(solid & close) + 1
        #: word numbers at which the rows begin, and the total
        self.first = np.searchsorted(self.starts, offsets).astype(np.int64)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def within(self) -> np.ndarray:
        """The number of each word within its row."""
        return np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.counts)

    def hashes(self, family: int = 0) -> np.ndarray:
        return hashes(self.data[self.solid], np.append(0, np.cumsum(self.ends - self.starts)), family)


def joined(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of each row's kept words, joined by one space."""
    starts, lens = words.starts[keep], (words.ends - words.starts)[keep]
    counts = np.bincount(words.row[keep], minlength=len(words.offsets) - 1)
    size = lens + 1
    out = np.cumsum(size) - size
    index = np.arange(int(size.sum())) + np.repeat(starts - out, size)
    if not len(index):
        return np.zeros(0, np.uint8), np.zeros(len(counts) + 1, np.int64)
    body = words.data[np.minimum(index, len(words.data) - 1)]
    body[out + lens] = 0x20
    last = np.cumsum(counts)
    solid = np.ones(len(body), bool)
    ends = (out + size)[last[counts > 0] - 1]
    solid[ends - 1] = False  # no space after a row's last word
    bounds = np.zeros(len(counts) + 1, np.int64)
    total = np.zeros(len(counts), np.int64)
    np.add.at(total, words.row[keep], size)
    total[counts > 0] -= 1
    np.cumsum(total, out=bounds[1:])
    return body[solid], bounds


def text_array(data: np.ndarray, offsets: np.ndarray, binary: bool = False) -> pa.Array:
    """A text (or binary) column from bytes and offsets."""
    kind = pa.large_binary() if binary else pa.large_string()
    column = pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return column.cast(pa.binary() if binary else pa.string())


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in an interval of ``width`` places from one of ``starts``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, size), -1)
    return np.cumsum(change[:-1]) > 0
