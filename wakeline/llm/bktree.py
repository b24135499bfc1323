"""BK-trees over 64-bit fingerprints with the Hamming distance.

Many trees are built and searched together as flat arrays: a node's children
are kept by their integer distance to it, and a search follows only children
whose distance differs from the query's by the radius at most.
"""

from __future__ import annotations

import numpy as np

WIDE = 65  # distances 0..64


class Forest:
    """One tree for each value of ``group``; ``points`` are unsigned, distinct
    within a group, and ``group`` is sorted."""

    def __init__(self, points: np.ndarray, group: np.ndarray):
        self.points = points
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, dtype=np.int64)
        self.roots = dict(zip(group[first].tolist(), first.tolist(), strict=True))
        here = np.repeat(first, np.diff(np.r_[first, len(group)]))
        todo = np.setdiff1d(np.arange(len(points)), first, assume_unique=True)
        here = here[todo]
        edge, child = [], []
        while len(todo):
            key = here * WIDE + np.bitwise_count(points[todo] ^ points[here]).astype(np.int64)
            new, at, back = np.unique(key, return_index=True, return_inverse=True)
            edge.append(new)
            child.append(todo[at])
            stays = np.ones(len(todo), dtype=bool)
            stays[at] = False
            here, todo = todo[at][back][stays], todo[stays]
        edge = np.concatenate(edge) if edge else np.zeros(0, dtype=np.int64)
        order = np.argsort(edge, kind="stable")
        self.edge = edge[order]
        self.child = (np.concatenate(child) if child else np.zeros(0, dtype=np.int64))[order]

    def search(self, query: np.ndarray, root: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes (of query, of point) with distance at most ``radius``;
        ``root`` is the root's index of the tree that each query searches."""

        q, node = np.arange(len(query)), root
        found_q, found_p = [], []
        while len(q):
            d = np.bitwise_count(query[q] ^ self.points[node]).astype(np.int64)
            hit = d <= radius
            found_q.append(q[hit])
            found_p.append(node[hit])
            lo = np.searchsorted(self.edge, node * WIDE + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.edge, node * WIDE + np.minimum(d + radius, WIDE - 1), "right")
            n = hi - lo
            q = np.repeat(q, n)
            start = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) if len(n) else n
            node = self.child[start + np.arange(len(q))]
        return np.concatenate(found_q or [q]), np.concatenate(found_p or [q])
