"""Signature trees: pairs of sets that may be similar enough, by a dual traversal of OR-combined bitmaps.

A set of 64-bit hashes has a bitmap of a power of two of bits, at least ``DENSITY`` a hash up to ``WIDEST``; bitmaps of two widths are
compared at the smaller one, which folds the larger. A node of the tree holds the OR of its members' bitmaps, the smallest and largest
of their sizes, and the most hashes that any of them loses to shared bits. Two nodes can hold a pair that shares at most

    min(largest sizes, bits that both bitmaps have + the smaller loss)

hashes; where that falls short of what the smallest sizes need, the node pair goes with everything under it. At the leaves the same
bound holds for the pair itself, so no similar pair is lost. A share is a pair of whole numbers (p, q): sets link when
q * |both| >= p * |either|.
"""
from __future__ import annotations

import numpy as np

FAN, DENSITY, WIDEST = 8, 4, 1 << 16
AT_ONCE = 1 << 20  # 64-bit words of bitmaps that a step compares
Share = tuple[int, int]


def enough(both, a, b, share: Share):
    """Whether sets of sizes a and b that share so many hashes link."""
    return (share[0] + share[1]) * both >= share[0] * (a + b)


def bitmaps(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Bitmaps of the sets ``hashes[first[i]:first[i + 1]]``."""
    sizes = np.diff(first)
    bits = np.minimum(WIDEST, np.maximum(64, 1 << np.ceil(np.log2(np.maximum(DENSITY * sizes, 1))).astype(np.int64)))
    ends = np.cumsum(bits // 64)
    starts = ends - bits // 64
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bit = (hashes & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    np.bitwise_or.at(out, starts[owner] + bit // 64, np.uint64(1) << (bit % 64).astype(np.uint64))
    return [out[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]


def _folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_or.reduce(bitmap.reshape(-1, words), axis=0)


class Tree:
    """Tree over bitmaps of one width; neighbours in the given order become siblings."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, fan: int = FAN):
        self.fan = fan
        self.levels = [(bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64))]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, lost = self.levels[-1]
            cuts = np.arange(0, len(low), fan)
            self.levels.append((np.bitwise_or.reduceat(bits, cuts, axis=0), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts), np.maximum.reduceat(lost, cuts)))

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray, share: Share) -> np.ndarray:
        bits, low, high, lost = self.levels[level]
        out, step = np.zeros(len(a), dtype=bool), max(1, AT_ONCE // bits.shape[1])
        for at in range(0, len(a), step):
            x, y = a[at:at + step], b[at:at + step]
            both = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64) + np.minimum(lost[x], lost[y])
            out[at:at + step] = enough(np.minimum(both, np.minimum(high[x], high[y])), low[x], low[y], share)
        return out

    def pairs(self, share: Share) -> tuple[np.ndarray, np.ndarray]:
        """Members a < b (places in the given order) that the bounds let through."""
        a = b = np.zeros(1, dtype=np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            size, fan = len(self.levels[level - 1][1]), self.fan
            x = (a[:, None, None] * fan + np.arange(fan)[:, None] + np.zeros((1, 1, fan), dtype=np.int64)).ravel()
            y = (b[:, None, None] * fan + np.arange(fan) + np.zeros((1, fan, 1), dtype=np.int64)).ravel()
            inside = (x < size) & (y < size) & ((x <= y) if level > 1 else (x < y))
            x, y = x[inside], y[inside]
            near = self._possible(level - 1, x, y, share) | ((x == y) & (level > 1))
            a, b = x[near], y[near]
        return (a, b) if len(self.levels) > 1 else (a[:0], b[:0])


def candidates(bitmaps_of: list[bytes], sizes: np.ndarray, order: np.ndarray, share: Share) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) of sets that may link. ``order`` puts sets that are likely to be similar side by side."""
    bits = [np.frombuffer(b, dtype=np.uint64) for b in bitmaps_of]
    width = np.array([len(b) for b in bits])
    left, right = [], []
    for words in np.unique(width):  # linked sets are of one width or of neighbouring ones while p / q is over a half
        mine = order[(width[order] == words) | (width[order] > words)] if share[0] * 2 <= share[1] else order[(width[order] == words) | (width[order] == 2 * words)]
        if len(mine) > 1:
            a, b = Tree(np.stack([_folded(bits[i], words) for i in mine]), sizes[mine]).pairs(share)
            a, b = mine[a], mine[b]
            own = (width[a] == words) | (width[b] == words)
            left.append(np.minimum(a, b)[own])
            right.append(np.maximum(a, b)[own])
    if not left:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


def forest(a: np.ndarray, b: np.ndarray, label: np.ndarray, links=None) -> tuple[list[int], list[int]]:
    """Some of the pairs a < b: as few as join what all of them join. Equal labels are joined already.

    Earlier members reach out first, so that groups that share their first member choose the same pairs. With ``links`` (of two
    members), pairs that do not link are passed over.
    """
    at = np.lexsort((b, a))
    a, b, label = a[at], b[at], label.copy()
    us, vs = [], []
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else []
    for x, others in zip(a[starts].tolist() if len(a) else [], np.split(b, starts[1:]) if len(a) else []):
        others = others[label[others] != label[x]]
        if links is None and len(others):
            _, one = np.unique(label[others], return_index=True)
            others = others[np.sort(one)]
        for y in others.tolist():
            if label[x] != label[y] and (links is None or links(x, y)):
                us.append(x)
                vs.append(y)
                label[label == label[y]] = label[x]
    return us, vs
