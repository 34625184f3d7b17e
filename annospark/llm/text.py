"""Texts of an Arrow batch as one byte array, worked on by numpy as a whole.

Words are ``[^\\x20\\x09-\\x0D]+``. All separators are single bytes of UTF-8, so words can be cut in the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Bytes that are hashed at once; a longer range is a window of its own.
_WINDOW = 1 << 18


def _powers_of(factor: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, factor, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_powers = [_powers_of(_BASE, _WINDOW + 1), _powers_of(_INVERSE, _WINDOW + 1)]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of whole rows with about ``limit`` bytes of text, so that arrays per byte stay small. At the
    end of a task the worker gives back what memory it holds unused."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the n + 1 offsets of its rows; a null row is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the n + 1 offsets of the rows into them."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SEPARATOR[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | fresh[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | fresh[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def coded(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The texts cut where ``cut`` is true and at the ends of rows: each part's number among the distinct parts, these, and
    the n + 1 offsets of the rows into the parts. Arrow builds the dictionary, so parts are compared exactly and no loop runs over them."""
    cut = np.append(cut, False)
    cut[offsets] = True
    cuts = np.flatnonzero(cut)
    if len(cuts) < 2:
        return np.zeros(0, np.int64), [], np.zeros(len(offsets), np.int64)
    parts = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    found = parts.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary.to_pylist(), np.searchsorted(cuts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, in order and apart: differences of one running polynomial sum, so no loop over ranges.

    The sum runs over windows, so memory does not follow the length of the text.
    """
    out, a = np.empty(len(starts), np.uint64), 0
    while a < len(starts):
        begin = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, begin + _WINDOW, "right")))
        part = data[begin : ends[b - 1]]
        powers = _powers if len(part) <= _WINDOW else [_powers_of(_BASE, len(part) + 1), _powers_of(_INVERSE, len(part) + 1)]
        running = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_CODES[part] * powers[0][: len(part)], out=running[1:])
        first, last = starts[a:b] - begin, ends[a:b] - begin
        out[a:b] = mixed((running[last] - running[first]) * powers[1][first] + (last - first).astype(np.uint64))
        a = b
    return out


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` within each row."""
    running = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=running[1:])
    return running[offsets[1:]] - running[offsets[:-1]]
