"""Cover trees over blocks of integer vectors, and assignment of whole subtrees to entries.

A node is a range of the points in tree order; its centre is one of them, and its radius covers
them. Dividing a node halves the radius: the first child keeps the centre
(nesting), every further centre is farther than half the radius from those before it
(separation), and every point goes to the first centre within half the radius (covering).
Groups too small to be worth a node stay with their parent as its loose points, last in its
range. Sums over any node come from cumulative sums in tree order.

Assignment goes down level by level. With the nearest entry at distance a from the centre, the
second nearest at b, and radius r, all points of a node belong to the nearest entry if
b - a > 2 r (triangle inequality; a margin for rounding makes the test refuse rather than err),
and the node's sum is added at once. Other nodes are ambiguous: their children are tried, their
loose points are compared exactly.
"""

from __future__ import annotations

import numpy as np

LEAF = 12  # a group of at most so many points is not a node
EXACT = 1 << 53  # integers below this are exact in doubles


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (points x entries) of integer vectors.

    By a matrix product in doubles where all its terms are exact integers, else in 64-bit integers.
    """
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * top * top * points.shape[1] < EXACT else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    return (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)[None, :]


def build(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, nodes, radii): tree order of the points; per node start, stop, start of its loose
    points, first and last child, place of its centre. The root is node 0, children have
    consecutive numbers."""
    order = np.arange(len(points))
    waiting = [(0, len(points), 0)] if len(points) else []
    nodes, radii = [], []
    for lo, hi, centre in waiting:  # grows while it is read
        own = order[lo:hi].copy()
        own[np.flatnonzero(own == centre)[0]], own[0] = own[0], centre
        away = (points[own] - points[centre]).astype(np.float64)
        radius = float(np.sqrt((away * away).sum(1).max()))
        first, at = len(waiting), lo
        if hi - lo > LEAF and radius > 0:
            groups = _cover(points[own], radius / 2)
            groups.sort(key=lambda g: (len(g) <= LEAF, g[0]))
            order[lo:hi] = own[np.concatenate(groups)]
            for g in groups:
                if len(g) > LEAF:
                    waiting.append((at, at + len(g), own[g[0]]))
                    at += len(g)
        nodes.append((lo, hi, at, first, len(waiting), centre))
        radii.append(radius)
    nodes = np.array(nodes, np.int64).reshape(-1, 6)
    nodes[:, 5] = np.argsort(order)[nodes[:, 5]]
    return order, nodes, np.array(radii, np.float64)


def _cover(points: np.ndarray, reach: float) -> list[np.ndarray]:
    """Places of ``points`` dealt to centres, each group with its centre first, point 0 first."""
    groups, left = [], np.arange(len(points))
    values = points.astype(np.float64)
    size = (values * values).sum(1)
    while len(left):
        # Several next centres are measured at once; one that an earlier one covers is skipped.
        some = left[:64]
        near = size[left][:, None] - 2 * (values[left] @ values[some].T) + size[some][None, :] <= reach * reach
        near[np.arange(len(some)), np.arange(len(some))] = True
        owner = near.argmax(1)
        owner[~near.any(1)] = -1
        # The first centre covering a point must itself be a centre: settle them in order.
        centre = np.zeros(len(some), bool)
        for k in range(len(some)):
            centre[k] = not (near[k, :k] & centre[:k]).any()
        near &= centre[None, :]
        owner = np.where(near.any(1), near.argmax(1), -1)
        owner[: len(some)][centre] = np.flatnonzero(centre)
        by = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[by], np.arange(len(some) + 1))
        for k in np.flatnonzero(centre):
            mine = left[by[cuts[k] : cuts[k + 1]]]
            groups.append(np.concatenate([[some[k]], mine[mine != some[k]]]))
        left = left[owner < 0]
    return groups


def assign(points: np.ndarray, nodes: np.ndarray, radii: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entry (ties to the lower index) of points in tree order; number and sum of every
    entry's points; how many points were compared one by one."""
    code = np.zeros(len(points), np.int64)
    count = np.zeros(len(entries), np.int64)
    total = np.zeros(entries.shape, np.int64)
    running = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0, dtype=np.int64)])
    compared = 0
    level = np.arange(min(1, len(nodes)))
    while len(level):
        start, stop, loose, first, last, centre = nodes[level].T
        d = squared(points[centre], entries)
        best = d.argmin(1)
        sure = np.ones(len(level), bool)
        if len(entries) > 1:
            near = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
            gap = near[:, 1] - near[:, 0] - 1e-9 * (1 + near[:, 1])
            sure = gap > 2 * radii[level] * (1 + 1e-9)
        code[ranges(start[sure], stop[sure])] = np.repeat(best[sure], (stop - start)[sure])
        np.add.at(count, best[sure], (stop - start)[sure])
        np.add.at(total, best[sure], running[stop[sure]] - running[start[sure]])
        rest = ranges(loose[~sure], stop[~sure])
        if len(rest):
            compared += len(rest)
            code[rest] = squared(points[rest], entries).argmin(1)
            np.add.at(count, code[rest], 1)
            np.add.at(total, code[rest], points[rest])
        level = ranges(first[~sure], last[~sure])
    return code, count, total, compared


def ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, stop), one range after the other."""
    size = stop - start
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
