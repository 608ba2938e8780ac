"""Arrow-batch text kernels shared by the operators of this subpackage.

Everything here works on one Arrow string column at a time: the UTF-8 buffer is viewed as a
NumPy array, words and n-grams of all its rows are found with whole-array operations, and no
Python string is made per word.  A null text counts as an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = {"n": 0, "up": np.zeros(0, _U), "down": np.zeros(0, _U)}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the bits of uint64 values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, grown when a longer input comes."""
    if _powers["n"] < n:
        size = max(n, CHUNK_BYTES + 1024)
        inverse = pow(_BASE, -1, 1 << 64)
        for key, base in (("up", _BASE), ("down", inverse)):
            table = np.full(size, base, _U)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            _powers[key] = table
        _powers["n"] = size
    return _powers["up"][:n], _powers["down"][:n]


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of the bytes that end a word; ranges include both ends."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: words [^\x20\x09-\x0D]+
WHITE = separators((0x20, 0x20), (0x09, 0x0D))
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the int64 offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give free memory back to the system.  Spark keeps a worker for later tasks, and Arrow's and C's allocators
    would keep what the batches before have freed."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `most` bytes of text; a longer text is a run of its own.

    After the last one free memory is released.
    """
    text = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end
    release()


class Words:
    """Words of the rows of a string column.

    starts, ends: byte places of the words; rows: offsets of each row's words in them;
    hashes: 64-bit hashes of the words, equal for equal words.
    """

    def __init__(self, column: pa.Array, ends_word: np.ndarray, lower: bool, hashed: bool = True):
        data, self.offsets = utf8(column)
        self.data = LOWER[data] if lower else data
        n = len(self.data)
        inside = ~ends_word[self.data]
        begins = np.zeros(n + 1, bool)
        begins[self.offsets] = True  # a row's first byte begins a word of its own
        first = inside.copy()
        first[1:] &= ~inside[:-1] | begins[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | begins[1:n]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.rows = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.rows)
        if hashed:
            up, down = _power_tables(n + 1)
            value = _BYTE[self.data]
            value *= up[:n]
            value[~inside] = 0
            sums = np.add.reduceat(value, self.starts) if len(self.starts) else np.zeros(0, _U)
            self.hashes = mix64(sums * down[self.starts])

    def of_row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k-word runs at every word, and whether the run stays in its row."""
        return window_hashes(self.hashes, self.rows, k)


def window_hashes(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(hashes)
    whole = np.repeat(rows[1:], np.diff(rows)) - np.arange(n) >= k
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(hashes * up[:n], out=sums[1:])
    end = np.minimum(np.arange(n) + k, n)
    return mix64((sums[end] - sums[:n]) * down[:n] + _U(k)), whole


def range_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit numbers of the word sequences begin..end among word hashes, equal for equal sequences."""
    n = len(hashes)
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mix64((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(_U))


def segment_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs that begin at starts and end at the next start (or the end)."""
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _power_tables(len(data) + 1)
    sums = np.add.reduceat(_BYTE[data] * up[: len(data)], starts)
    sizes = np.diff(np.r_[starts, len(data)])
    return mix64(sums * down[starts] + sizes.astype(_U))


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows as uint32, and the offsets of the rows in them."""
    data, offsets = utf8(column)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, lead[offsets]


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == _U else x.astype(np.int64)


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column out of its flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
