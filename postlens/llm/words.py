"""Words of Arrow text columns as hash arrays, for functions that run inside tasks.

A block of rows is one byte array with row offsets. Words are runs of bytes of one class, and
their hashes come from one running sum over the block, so no Python object is made per word.
Words are cut by byte class: every byte of a non-ASCII letter counts as a letter.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 2048
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(MULTIPLIER, -1, 1 << 64)

LETTER, DIGIT, SYMBOL = 1, 2, 3


def byte_classes(symbols: bool = False, joined: bool = True) -> np.ndarray:
    """Class of each byte: 0 separates. ``joined`` puts digits and letters into one class."""
    table = np.zeros(256, np.uint8)
    table[0x21:0x7F] = SYMBOL if symbols else 0
    for first, last in (("a", "z"), ("A", "Z")):
        table[ord(first): ord(last) + 1] = LETTER
    table[0x80:] = LETTER
    table[ord("0"): ord("9") + 1] = LETTER if joined else DIGIT
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fold_one(text: str) -> str:
    return "".join(
        low if len((low := c.lower()).encode()) == len(c.encode()) else c for c in text
    )


def folded(column: pa.Array) -> pa.Array:
    """Lower case. A letter whose lower case has another byte length stays as it is, so
    positions in the result are positions in the text."""
    low = pc.utf8_lower(column)
    same = pc.equal(pc.binary_length(low), pc.binary_length(column))
    if pc.all(same).as_py() is False:
        keep = same.to_pylist()
        low = pa.array(
            [a if k else _fold_one(b) for a, k, b in zip(low.to_pylist(), keep, column.to_pylist())],
            low.type,
        )
    return low


def strings(column: pa.Array) -> pa.Array:
    """The column without nulls, with 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a column that ``strings`` returned."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def release():
    """Give freed memory back to the system. Workers live on from stage to stage, beside those of other cores."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def blocks(column: pa.Array, size: int = BLOCK_BYTES, rows: int = BLOCK_ROWS):
    """Ranges [lo, hi) of rows of at most ``size`` bytes together; a longer text is alone. What
    was freed meanwhile is given back at the end."""
    _, offsets = raw(column)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, len(column))
        yield lo, hi
        lo = hi
    release()


class Words:
    """Words of one block: byte ranges, row numbers and hashes, in text order."""

    def __init__(self, data, offsets, start, end, hashes, doc):
        self.data, self.offsets = data, offsets
        self.start, self.end, self.hash, self.doc = start, end, hashes, doc
        self.rows = len(offsets) - 1
        self.first = np.searchsorted(doc, np.arange(self.rows + 1))
        self.count = np.diff(self.first)

    def __len__(self):
        return len(self.start)


class Reader:
    """Cuts blocks into words; keeps the powers that the hashes need."""

    def __init__(self, classes: np.ndarray):
        self.classes = classes
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int):
        if len(self.powers) < n:
            def table(base):
                out = np.full(n, base, np.uint64)
                out[0] = 1
                return np.multiply.accumulate(out)
            self.powers, self.inverses = table(MULTIPLIER), table(INVERSE)

    def hashes(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each range of ``values``; equal ranges have equal hashes."""
        self._grow(len(values) + 1)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=total[1:])
        with np.errstate(over="ignore"):
            h = (total[end] - total[start]) * self.inverses[start]
            return mix(h + (end - start).astype(np.uint64) * np.uint64(MULTIPLIER))

    def read(self, column: pa.Array) -> Words:
        data, offsets = raw(column)
        n = len(data)
        kind = self.classes[data]
        edge = np.ones(n + 1, bool)
        edge[1:n] = kind[1:] != kind[:-1]
        edge[offsets] = True
        inside = kind > 0
        start = np.flatnonzero(edge[:n] & inside)
        end = np.flatnonzero(edge[1:] & inside) + 1
        doc = np.searchsorted(offsets, start, "right") - 1
        hashes = self.hashes(data.astype(np.uint64) + np.uint64(1), start, end)
        return Words(data, offsets, start, end, hashes, doc)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, row, hash) of every run of ``size`` words inside one row. A row with fewer
    words has one run, of all its words."""
    h = words.hash
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    left = words.first[1:][words.doc] - np.arange(n)
    short = words.count[words.doc] < size
    at = np.flatnonzero((left >= size) | (short & (words.first[:-1][words.doc] == np.arange(n))))
    length = np.minimum(left[at], size)
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            there = j < length
            word = np.where(there, h[np.minimum(at + j, n - 1)], np.uint64(0))
            out = mix(out * np.uint64(MULTIPLIER) + word)
    return at, words.doc[at], out
