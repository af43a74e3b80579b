"""SuperMinHash signatures of many sets at once.

Every element draws a permutation of the slots and, for rank j = 0, 1, 2, ..., a value in
[j, j + 1) for the slot of that rank; a slot keeps its smallest value. The ranks of one
element are correlated (each slot once), which lowers the variance of the estimated
similarity below that of independent minima. A set is finished at the first rank after
which no slot can improve: all its slots hold a value below the next rank. The ranks are
walked for all sets together, and finished sets leave the arrays.
"""

from __future__ import annotations

import numpy as np

from terrace.llm.textvec import mix64

_RANK = np.uint64(32)


def signatures(values: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    """One row of ``slots`` 64-bit values per set; sets are given one after another.

    The upper 32 bits hold the rank, the lower the draw, so that integers compare as the
    reals j + r do. An empty set keeps the largest integer in every slot.
    """
    n_sets = len(counts)
    out = np.full(n_sets * slots, np.iinfo(np.uint64).max, np.uint64)
    table = out.reshape(n_sets, slots)
    owner = np.repeat(np.arange(n_sets), counts)
    live = np.flatnonzero(counts > 0)
    state, perm = values, None
    for j in range(slots):
        draw = mix64(state + np.uint64(j * 0xA0761D6478BD642F % 2**64))
        k = j + ((draw >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if perm is None:
            slot = k
        else:
            rows = np.arange(len(state))
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
            perm[:, j] = slot
        value = (np.uint64(j) << _RANK) | (mix64(draw) >> np.uint64(32))
        np.minimum.at(out, owner * slots + slot, value)
        open_ = table[live].max(axis=1) >= (np.uint64(j + 1) << _RANK)
        if not open_.any() or j + 1 == slots:
            break
        live = live[open_]
        keep_set = np.zeros(n_sets, bool)
        keep_set[live] = True
        keep = keep_set[owner]
        if perm is None:
            state, owner, first = state[keep], owner[keep], slot[keep]
            perm = np.tile(np.arange(slots, dtype=np.uint16), (len(state), 1))
            rows = np.arange(len(state))
            perm[rows, first] = perm[:, 0]
            perm[:, 0] = first
        elif keep.mean() < 0.7:
            state, owner, perm = state[keep], owner[keep], perm[keep]
    return table


def band_keys(table: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` slots; the band's number is part of the key."""
    n, slots = table.shape
    bands = slots // rows
    cut = table[:, : bands * rows].reshape(n, bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), (n, bands)).copy()
    for r in range(rows):
        key = mix64(key * np.uint64(0xE7037ED1A0B428DB) + cut[:, :, r])
    return key
