"""Small helpers for code that works on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds about ``limit``
    bytes at most (one longer row makes a run of its own)."""

    n = batch.num_rows
    if not n:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    at, used = 0, 0
    for i, k in enumerate(size.tolist()):
        if i > at and used + k > limit:
            yield batch.slice(at, i - at)
            at, used = i, 0
        used += k
    yield batch.slice(at, n - at)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing of unsigned integers (finaliser of splitmix64)."""

    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest with the same components as the edges (a, b): every
    vertex except the smallest of its component is joined to that smallest."""

    if not len(a):
        return a, b
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = idx[: len(a)], idx[len(a):]
    lab = np.arange(len(nodes))
    while True:
        low = np.minimum(lab[x], lab[y])
        new = lab.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, lab[x], low)
        np.minimum.at(new, lab[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, lab):
            break
        lab = new
    moved = lab != np.arange(len(nodes))
    return nodes[moved], nodes[lab[moved]]
