"""Vectorised word hashing over Arrow text columns.

Bytes of many texts are handled at once with numpy; nothing runs per word in Python. Work
is cut into pieces of a bounded number of bytes (a longer text is a piece of its own), so
the memory of a task does not follow the size of Arrow batches.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LETTERS = np.random.default_rng(7).integers(1, 2**64, 256, dtype=np.uint64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): equal in, equal out, and well spread."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    up, down = np.full(n, _BASE), np.full(n, np.uint64(pow(int(_BASE), -1, 2**64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def pieces(text: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into the bytes) of consecutive pieces. NULL is empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    wide = pa.types.is_large_string(text.type)
    _, offsets, data = text.buffers()
    n = len(text)
    if n == 0:
        return
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(off, off[first] + limit, "right")) - 1
        end = min(n, max(first + 1, end))
        yield first, end, raw[off[first] : off[end]], off[first : end + 1] - off[first]
        first = end


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word with A-Z lower-cased, number of words of each row)."""
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(off) - 1, np.int64)
    inside = ~_SPACE[raw]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    starts_of_rows = off[:-1][off[:-1] < len(raw)]
    before[starts_of_rows] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    up, down = _powers(max(PIECE_BYTES, 1 << int(len(raw) - 1).bit_length()))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LETTERS[_LOWER[raw]] * up[: len(raw)], out=total[1:])
    hashes = mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    per_row = np.diff(np.searchsorted(start, off))
    return hashes, per_row


def shingles(raw: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ``size``-word shingle hashes of every row, sorted inside it, their number per row).

    A row with fewer words has its whole sequence as its one shingle; without words, none.
    """
    w, per_row = words(raw, off)
    ends = np.cumsum(per_row)
    n = len(w) - size + 1
    runs = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        runs = runs * np.uint64(0xD6E8FEB86659FD93) + w[k : k + max(n, 0)]
    runs = mix64(runs)
    sets, at = [], 0
    for end, count in zip(ends, per_row, strict=True):
        if count >= size:
            sets.append(np.unique(runs[at : end - size + 1]))
        elif count:
            whole = np.array([count], np.uint64)
            for h in w[at:end]:
                whole = mix64(whole * np.uint64(3) + h)
            sets.append(whole)
        else:
            sets.append(np.empty(0, np.uint64))
        at = end
    counts = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), counts
