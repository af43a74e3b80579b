"""Compressed FM-index over word sequences: wavelet matrix of the Burrows-Wheeler transform.

The text is a set of sequences, each ended by a mark of its own. A suffix array (prefix
doubling) gives the transform; its symbols are kept in a wavelet matrix, one bit vector per bit
of a symbol, packed to words with block counts, so a symbol costs its bits and little more. The
suffix array itself is dropped but for the weights of suffixes, added up in their order.

Backward search narrows an interval of suffixes from the last symbol of a pattern to the
first. It runs for many patterns at once, one step of all of them being a few array operations.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start places of all suffixes in order; ``symbols`` must end in a symbol found nowhere else."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    n, step = len(rank), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        new = np.empty(n, np.int64)
        key = key[order]
        new[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = new
        step *= 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class BitVector:
    """Packed bits with the number of ones before every 64."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1]

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones in the first ``at`` bits."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.levels: list[tuple[BitVector, int]] = []
        for shift in range(self.bits - 1, -1, -1):
            bit = (symbols >> shift) & 1
            self.levels.append((BitVector(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        every = np.arange(size)
        self.start = self._descend(every, np.zeros(size, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (vector, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            ones = vector.ones(at)
            at = np.where(one, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the first ``at`` places."""
        return self._descend(symbol, at) - self.start[symbol]


class FMIndex:
    """Index of ``sequences`` (arrays of symbols 0 .. size - 1), each standing ``weights`` times."""

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray, size: int):
        many = len(sequences)
        lengths = np.array([len(s) for s in sequences], np.int64)
        # Marks 0 .. many - 1, then the symbols; every mark ends one sequence.
        text = np.empty(int(lengths.sum()) + many, np.int64)
        ends = np.cumsum(lengths + 1) - 1
        inner = np.ones(len(text), bool)
        inner[ends] = False
        text[ends] = np.arange(many)
        text[inner] = np.concatenate(sequences) + many if many else 0
        order = suffix_order(text) if many else np.zeros(0, np.int64)
        # All marks are one symbol of the transform, 0; symbol s is s + 1.
        plain = np.where(inner, text - many + 1, 0)
        self.size = size
        self.matrix = WaveletMatrix(plain[order - 1], size + 1)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(plain, minlength=size + 1))])
        owner = np.repeat(np.arange(many), lengths + 1)
        self.running = np.concatenate([[0], np.cumsum(np.asarray(weights, np.int64)[owner[order]])])

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes that start with ``symbol`` and go on as those of [low, high)."""
        symbol = symbol + 1
        both = self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high])) + np.tile(self.first[symbol], 2)
        return both[: len(symbol)], both[len(symbol) :]

    def occurrences(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Weighted number of suffixes in the intervals."""
        return self.running[high] - self.running[low]

    def repeated(self, sequences: list[np.ndarray], window: int) -> list[np.ndarray]:
        """Per sequence the starts of its windows of ``window`` symbols that occur twice and more.

        Matching statistics from the right: from an end, backward search goes on while the match
        occurs twice. A match of l symbols settles every window that it holds (repeated, if
        l >= window) and every window that holds the match and the symbol before it (not
        repeated), so the next end is that of the last window not settled. All sequences advance
        together, so a step costs a few array operations for all of them.
        """
        lengths = np.array([len(s) for s in sequences], np.int64)
        flat = np.concatenate(sequences) if len(sequences) else np.zeros(0, np.int64)
        base = np.cumsum(lengths) - lengths
        found = np.zeros(len(flat), bool)  # by place of the window's start
        lane = np.flatnonzero(lengths >= window)
        end = lengths[lane].copy()
        at = end.copy()  # [at, end) is the match so far
        total = self.first[-1]
        low, high = np.zeros(len(lane), np.int64), np.full(len(lane), total)
        while len(lane):
            more = at > 0
            symbol = flat[base[lane] + np.maximum(at, 1) - 1]
            new_low, new_high = self.step(symbol, low, high)
            grown = more & (self.occurrences(new_low, new_high) >= 2)
            low, high, at = np.where(grown, new_low, low), np.where(grown, new_high, high), at - grown
            # Matches that cannot grow settle windows: those inside them, and those that hold
            # them with the symbol before.
            stop = np.flatnonzero(~grown)
            if len(stop):
                long = stop[end[stop] - at[stop] >= window]
                starts = _ranges(base[lane[long]] + at[long], base[lane[long]] + end[long] - window + 1)
                found[starts] = True
                # The last window that starts before the match and does not hold its end.
                end[stop] = np.minimum(at[stop] + window - 1, end[stop] - 1)
                at[stop], low[stop], high[stop] = end[stop], 0, total
                live = np.ones(len(lane), bool)
                live[stop] = end[stop] >= window
                if not live.all():
                    lane, end, at, low, high = lane[live], end[live], at[live], low[live], high[live]
        return [np.flatnonzero(found[b : b + n]) for b, n in zip(base.tolist(), lengths.tolist(), strict=True)]


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    size = stop - start
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
