"""Words of whole texts as 64-bit hashes, computed on Arrow buffers.

A word is ``[^\\x20\\x09-\\x0D]+``. All functions work on the UTF-8 bytes of a batch in
pieces of about a megabyte, so memory does not follow the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray | int, seed: int = 0) -> np.ndarray:
    """Scatter 64-bit numbers (two rounds of xor-shift and multiplication)."""
    x = np.asarray(x).astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTES = mix(np.arange(256), 1)
LOWERED = BYTES.copy()
LOWERED[65:91] = BYTES[97:123]
PLACES = mix(np.arange(4096), 2) | np.uint64(1)


def _place(at: np.ndarray) -> np.ndarray:
    if len(at) and int(at.max()) >= len(PLACES):
        return mix(at, 2) | np.uint64(1)
    return PLACES[at]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null row is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans that cover the rows and end at a row's end or at white space."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = at + PIECE_BYTES
        if to >= end:
            yield at, end
            return
        row_end = int(offsets[np.searchsorted(offsets, to)])
        step = to
        while step < row_end:
            space = np.flatnonzero(SPACE[data[step : min(step + 4096, row_end)]])
            if len(space):
                step += int(space[0])
                break
            step = min(step + 4096, row_end)
        yield at, step
        at = step


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in order, and the offsets of the rows in that array."""
    return placed_words(data, offsets, lower)[:2]


def placed_words(
    data: np.ndarray, offsets: np.ndarray, lower: bool, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``hash_words``, and the first byte and size of each word; ``separators`` is a table over bytes."""
    table = LOWERED if lower else BYTES
    hashes, firsts, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in _pieces(data, offsets):
        inside = ~separators[data[lo:hi]]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi)] - lo
        begins[edges] = inside[edges]
        where = np.flatnonzero(begins)
        if not len(where):
            continue
        ends = inside.copy()
        ends[:-1] &= begins[1:] | ~inside[1:]
        sizes = np.flatnonzero(ends) - where + 1
        at = np.cumsum(sizes) - sizes
        letters = data[lo:hi][inside]
        place = np.arange(len(letters)) - np.repeat(at, sizes)
        sums = np.add.reduceat(table[letters] * _place(place), at)
        hashes.append(mix(sums + sizes.astype(np.uint64), 3))
        firsts.append(where + lo)
        lengths.append(sizes)
    first = np.concatenate(firsts)
    return np.concatenate(hashes), np.searchsorted(first, offsets), first, np.concatenate(lengths)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """Row number of every element of a ragged array."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbours; runs over a row's end are for the caller to drop."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += hashes[k : k + n] * PLACES[k + 64]
    return mix(out, 4)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 * PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``most`` bytes of ``column``, one row at least."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
