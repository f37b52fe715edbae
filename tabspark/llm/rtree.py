"""An R-tree over group-count vectors, for joins on the number of common members.

A set's members are hashed into ``GROUPS`` groups; its point has the count of each group.
Two sets have at most the sum of their coordinate minima in common, and a set has at most
the sum of minima with a node's upper corner in common with anything below that node. So
the tree keeps upper corners (and the least set size, which the needed overlap grows with).
"""

from __future__ import annotations

import numpy as np

GROUPS = 256
#: Points of a leaf, and children of an inner node.
FAN = 16


def point(members: np.ndarray) -> bytes:
    """The group counts of a set of 64-bit hashes: a byte each, or four if one needs them."""
    counts = np.bincount((members >> np.uint64(7)).astype("i8") & GROUPS - 1, minlength=GROUPS)
    return counts.astype("u1" if counts.max() < 256 else "<u4").tobytes()


def points_of(packed: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x, "u1" if len(x) == GROUPS else "<u4").astype("i4") for x in packed])


def needed(a, b, percent: int):
    """The least overlap of sets of sizes a and b whose Jaccard similarity is ``percent`` or more."""
    return -(-percent * (a + b) // (100 + percent))


class RTree:
    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        """Bulk load: sorted by size, then sliced by the most spread coordinates (STR)."""
        self.order = self._tile(points, sizes)
        self.points, self.sizes = points[self.order], sizes[self.order].astype("i8")
        self.levels = []  # from the leaves up: upper corners, least sizes
        corner, least = self.points, self.sizes
        while len(corner) > FAN:
            cuts = np.arange(0, len(corner), FAN)
            corner, least = np.maximum.reduceat(corner, cuts), np.minimum.reduceat(least, cuts)
            self.levels.append((corner, least))

    @staticmethod
    def _tile(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        order = np.argsort(sizes, kind="stable")
        axes = np.argsort(-points.astype("f8").var(axis=0), kind="stable")[:2] if len(points) > FAN else []
        spans = [(0, len(order))]
        for axis in axes:
            out = []
            for s, e in spans:
                if e - s <= FAN:
                    out.append((s, e))
                    continue
                order[s:e] = order[s:e][np.argsort(points[order[s:e], axis], kind="stable")]
                step = max(FAN, int(np.sqrt((e - s) / FAN)) * FAN)
                out += [(i, min(i + step, e)) for i in range(s, e, step)]
            spans = out
        return order

    def search(self, point: np.ndarray, size: int, percent: int, alive: np.ndarray | None = None) -> np.ndarray:
        """Original numbers of the points that may belong to sets similar to this one."""
        q = point
        at = np.arange(len(self.levels[-1][0]) if self.levels else len(self.points))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, least = self.levels[depth]
            bound = np.minimum(corner[at], q).sum(axis=1)
            at = at[bound >= needed(size, least[at], percent)]
            below = len(self.levels[depth - 1][0]) if depth else len(self.points)
            at = (at[:, None] * FAN + np.arange(FAN)).ravel()
            at = at[at < below]
        if alive is not None:
            at = at[alive[self.order[at]]]
        sizes = self.sizes[at]
        fits = (100 * sizes >= percent * size) & (100 * size >= percent * sizes)
        at, sizes = at[fits], sizes[fits]
        bound = np.minimum(self.points[at], q).sum(axis=1)
        return self.order[at[bound >= needed(size, sizes, percent)]]


class Union:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two ascending arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
