"""Words of whole texts as numpy arrays, straight from Arrow's buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Hashes are 64 bits wide: a
polynomial over random byte codes, taken from prefix sums, then mixed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U = np.uint64

_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 1 << 64)
_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**i and STEP**-i for i up to n, modulo 2**64."""
    have = _POWERS.get("p")
    if have is None or len(have[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + (64 << 10))
        up, down = np.full(size, _STEP, np.uint64), np.full(size, _BACK, np.uint64)
        up[0] = down[0] = 1
        have = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        if size <= 4 * CHUNK_BYTES:
            _POWERS["p"] = have
    return have


def release() -> None:
    """Give freed memory back to the system: a worker lives through many tasks beside the executor's own heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most limit bytes of text each; a longer text is a slice of its own."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < n:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(n, max(end, at + 1))
            yield batch.slice(at, end - at)
            at = end
    release()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the offsets of each row in them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    raw = column.buffers()
    if n == 0 or raw[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(raw[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of every word."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e
    solid = ~_SPACE[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = ~solid[:-1]
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = ~solid[1:]
    starts = np.flatnonzero(solid & (before | begins[:-1]))
    ends = np.flatnonzero(solid & (after | begins[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    if lower:
        data = _LOWER[data]
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_CODES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of hashes[i:i+n] for every i that has n; whether they lie in one row is the caller's matter."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, seed, np.uint64)
    for j in range(n):
        out *= U(_STEP)
        out += hashes[j : j + m]
    return mix(out)


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n) if len(rows) else np.zeros(n, np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of every row, lower-cased: (row, hash), sorted by row, then hash.

    A row of fewer words has its whole sequence as one shingle, a row without words none.
    """
    starts, ends, rows = words(data, offsets)
    hashes = word_hashes(data, starts, ends, lower=True)
    count = len(offsets) - 1
    per_row = row_counts(rows, count)
    first = np.zeros(count + 1, np.int64)
    np.cumsum(per_row, out=first[1:])
    grams = gram_hashes(hashes, n, seed=n)
    same = rows[: len(grams)] == rows[n - 1 : n - 1 + len(grams)] if len(grams) else np.zeros(0, bool)
    g, r = grams[same], rows[: len(grams)][same]
    short = np.flatnonzero((per_row > 0) & (per_row < n))
    if len(short):
        value = np.zeros(len(short), np.uint64)
        for j in range(n - 1):
            live = per_row[short] > j
            value[live] = value[live] * U(_STEP) + hashes[first[short[live]] + j]
        value = mix(value + per_row[short].astype(np.uint64) * U(0xD6E8FEB86659FD93))
        g, r = np.concatenate([g, value]), np.concatenate([r, short])
    if not len(g):
        return np.zeros(0, np.int64), g
    return distinct_pairs(r, g)


def distinct_pairs(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value), sorted by row, then value; rows need not be sorted."""
    order = np.argsort(rows, kind="stable")
    rows, values = rows[order], values[order]
    edges = np.flatnonzero(np.diff(rows)) + 1
    bounds = np.concatenate([[0], edges, [len(rows)]])
    values = values.copy()
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[i:j].sort()
    keep = np.empty(len(rows), bool)
    keep[0] = True
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return rows[keep], values[keep]
