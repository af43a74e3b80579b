"""Gap-weighted subsequence kernel over short character windows, with Nyström features.

A window is up to ``WIDTH`` characters of ``^word$``. Its features are the subsequences of
three characters, gaps allowed, weighted DECAY ** (characters inside the gaps), so a word
with an inserted or dropped character shares most features with the word itself. The
kernel of two windows is the product of their feature vectors, divided by a norm per window
length. Features are hashed to ``DIMS`` places.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

WIDTH = 7
DECAY = 0.6
DIMS = 1 << 17
START, STOP = 1, 2

TRIPLES = np.array([t for t in combinations(range(WIDTH), 3)])
WEIGHTS = DECAY ** (TRIPLES[:, 2] - TRIPLES[:, 0] - 2).astype(np.float64)
_NORM = np.array([1.0] + [np.sqrt(max(1e-9, (WEIGHTS[TRIPLES[:, 2] < n] ** 2).sum())) for n in range(1, WIDTH + 1)])

# Code points below 65536 by kind: 0 left out, 1 letter or digit, 2 white space, 3 end of text.
KIND = np.array([1 if chr(c).isalnum() else 0 for c in range(0xD800)] + [1] * (0x10000 - 0xD800), np.uint8)
KIND[[0x20, *range(0x09, 0x0E), 0x85, 0xA0, 0x2028, 0x2029]] = 2
KIND[0] = 3


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters of all words, offset of each word and the end, text of each word).

    Lower case; a word is what stands between white space, without its punctuation, so
    ``i.d.i.o.t`` is one word; a run of single letters (``i d i o t``) is one word too.
    """
    joined = "\0".join((t or "").replace("\0", " ") for t in texts).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = KIND[np.minimum(codes, 0xFFFF)]
    codes, kind = codes[kind > 0], kind[kind > 0]
    letter = kind == 1
    before = np.zeros(len(letter), bool)
    before[1:] = letter[:-1]
    start = np.flatnonzero(letter & ~before)
    owner = np.cumsum(kind == 3)[start] if len(start) else start
    letters = codes[letter]
    at = np.cumsum(letter)[start] - 1 if len(start) else start
    offsets = np.append(at, len(letters))
    single = np.diff(offsets) == 1
    joins = np.zeros(len(start), bool)
    joins[1:] = single[1:] & single[:-1] & (owner[1:] == owner[:-1])
    return letters, np.append(at[~joins], len(letters)), owner[~joins]


def distinct(letters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one word per distinct word, number of its distinct word for every word)."""
    from terrace.llm.textvec import _powers, mix64

    n = len(letters)
    up, down = _powers(max(1 << 20, 1 << int(max(n, 1)).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix64(letters.astype(np.uint64)) * up[:n], out=total[1:])
    s, e = offsets[:-1], offsets[1:]
    _, first, back = np.unique((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64), return_index=True, return_inverse=True)
    return first, back


def windows(letters: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all windows of the chosen words, WIDTH wide and 0 past the end; windows per word)."""
    size = offsets[chosen + 1] - offsets[chosen] + 2
    end = np.cumsum(size)
    begin = end - size
    chain = np.zeros(int(end[-1]) + WIDTH if len(end) else WIDTH, np.uint32)
    chain[begin], chain[end - 1] = START, STOP
    inner = size - 2
    within = np.arange(int(inner.sum())) - np.repeat(np.cumsum(inner) - inner, inner)
    chain[np.repeat(begin + 1, inner) + within] = letters[np.repeat(offsets[chosen], inner) + within]
    count = np.maximum(1, size - WIDTH + 1)
    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    first = np.repeat(begin, count) + within
    places = first[:, None] + np.arange(WIDTH)
    out = chain[places]
    out[places >= np.repeat(end, count)[:, None]] = 0
    return out, count


def encode(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)


def windows_of(words_: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = [encode(w) for w in words_]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    letters = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    return windows(letters, offsets, np.arange(len(parts)))


def places(codes: np.ndarray, triple: np.ndarray) -> np.ndarray:
    """Hashed place of one subsequence of every window."""
    a, b, c = (codes[:, i].astype(np.uint64) for i in triple)
    h = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + c * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 17)).astype(np.int64)


def norms(codes: np.ndarray) -> np.ndarray:
    return _NORM[(codes != 0).sum(axis=1)]


def project(codes: np.ndarray, table: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
    """Normalised features of every window times ``table`` (one row per place, or per ``row`` of a place)."""
    out = np.zeros((len(codes), *table.shape[1:]), np.float32)
    for triple, weight in zip(TRIPLES, WEIGHTS, strict=True):
        at = places(codes, triple)
        part = table[at if row is None else row[at]] * np.float32(weight)
        part[codes[:, triple[2]] == 0] = 0
        out += part
    scale = norms(codes).astype(np.float32)
    return out / (scale if out.ndim == 1 else scale[:, None])


def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised feature vectors of landmarks, as columns over the places that any of them has.

    (row of every place, rows x windows). A window has at most ``len(TRIPLES)`` places, so few
    of the DIMS are used; row 0 stands for all others and is zero.
    """
    found = np.stack([places(codes, triple) for triple in TRIPLES])
    live = codes[:, TRIPLES[:, 2]].T != 0
    used = np.unique(found[live])
    row = np.zeros(DIMS, np.int32)
    row[used] = np.arange(1, len(used) + 1)
    out = np.zeros((len(used) + 1, len(codes)), np.float32)
    columns = np.arange(len(codes))
    for k, weight in enumerate(WEIGHTS):
        np.add.at(out, (row[found[k][live[k]]], columns[live[k]]), np.float32(weight))
    out /= norms(codes).astype(np.float32)
    return row, out


def train_svm(
    landmarks: np.ndarray, codes: np.ndarray, y: np.ndarray, share: np.ndarray, c: float = 1000.0
) -> tuple[np.ndarray, float]:
    """Squared-hinge support vector machine on Nyström features; (weights over DIMS, bias).

    With K the kernel of the landmarks, a window's feature is k(window, landmarks) K^(-1/2).
    The machine is linear in it, so its weights fold back into one vector over the hashed
    subsequences. An example counts ``share``; both classes weigh the same in all.
    """
    row, phi = features(landmarks)
    gram = (phi.T @ phi).astype(np.float64)
    value, vector = np.linalg.eigh(gram)
    good = value > 1e-4 * value.max()
    root = (vector[:, good] / np.sqrt(value[good])) @ vector[:, good].T
    z = np.ones((len(codes), len(root) + 1))
    for at in range(0, len(codes), 4096):
        z[at : at + 4096, :-1] = project(codes[at : at + 4096], phi, row) @ root
    weight = share * np.where(y > 0, 0.5 / max(1.0, share[y > 0].sum()), 0.5 / max(1.0, share[y < 0].sum())) * len(y)
    u = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1]) / c
    ridge[-1, -1] = 1e-6
    active = None
    for _ in range(30):
        now = y * (z @ u) < 1
        if active is not None and (now == active).all():
            break
        active = now
        zn = z[now]
        right = zn.T @ (weight[now] * y[now])
        zn *= np.sqrt(weight[now])[:, None]
        u = np.linalg.solve(ridge * len(y) / 100 + zn.T @ zn, right)
    return (phi @ (root @ u[:-1]))[row].astype(np.float32), float(u[-1])


FLOOR, CEILING, HIT = -1.0, 2.0, 0.6
N_FEATURES = 5


def text_features(texts: list[str | None], table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Evidence in every text under two machines (columns of ``table``): sure and likely words.

    The two largest values of the first machine, log(1 + its hits), log(1 + hits of the
    second) and the second's log hits per hundred words; a hit is a word above HIT. Values
    lie between FLOOR and CEILING. Only the density depends on the length of the text.
    """
    out = np.zeros((len(texts), N_FEATURES))
    out[:, :2], out[:, 4] = FLOOR, -5.0
    letters, offsets, owner = words(texts)
    if not len(owner):
        return out
    first, back = distinct(letters, offsets)
    best = np.empty((len(first), 2), np.float32)
    size = offsets[first + 1] - offsets[first] + 2
    cuts = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + 1, 100_000))
    cuts = np.unique(np.append(cuts, len(first)))
    for lo, hi in zip(np.append(0, cuts[:-1]), cuts, strict=True):
        if hi > lo:
            codes, count = windows(letters, offsets, first[lo:hi])
            best[lo:hi] = np.maximum.reduceat(project(codes, table), np.cumsum(count) - count)
    best += bias.astype(np.float32)
    sure = best[back, 0]
    some = np.flatnonzero(sure > FLOOR)
    some = some[np.lexsort((-sure[some], owner[some]))]
    row = owner[some]
    place = np.arange(len(some)) - np.searchsorted(row, row)
    top = place < 2
    out[row[top], place[top]] = np.minimum(sure[some][top], CEILING)
    n = np.bincount(owner, minlength=len(texts))
    hits = [np.bincount(owner[best[back, m] > HIT], minlength=len(texts)) for m in (0, 1)]
    out[:, 2], out[:, 3] = np.log1p(hits[0]), np.log1p(hits[1])
    dense = hits[1] > 0
    out[dense, 4] = np.clip(np.log(100 * hits[1][dense] / (n[dense] + 100)), -5, 3)
    return out
