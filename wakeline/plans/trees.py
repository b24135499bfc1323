"""Regression trees for several targets at once, grown on Spark.

Features are binned once by quantiles, so a split is a feature and a bin, and one
split serves all targets: the one that takes most off the sum of their squared
errors. Nodes with many rows are split by level: every task sums weight and
targets by (node, feature, bin) over its rows, the sums of one node meet in one
group, and only its best split goes to the driver. A node with at most
``LOCAL_ROWS`` rows is finished by the one task that its rows are sent to, in
packed blocks. Nodes of fewer rows than bins are summed by the bins that they
hold, so a level costs as much as its rows and not as its nodes times bins. The
trees of a wave share these passes.

A ``Forest`` with small leaves grows with its training rows. Its trees stay in a
table, one row for what one task has finished; only the splits of the large nodes
are known to the driver. Rows to be predicted go to the parts that they fall into,
tree by tree, and the values of a block of rows meet again in one group.

Rows are drawn for a tree with a Poisson weight that is a hash of row, tree and
seed, so a repeated task draws the same.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wakeline.scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

BINS = 256
LOCAL_ROWS = 500_000  # packed, some 30 MB
NODES_PER_PASS = 256
BLOCK_ROWS = 65_536  # rows that a task handles, and packs for one node, at once
CELLS = 1 << 17  # (node, feature, bin) sums that are worked on at once
WAVE_ROWS = 100_000_000  # drawn rows that one wave of trees sends to its tasks
PREDICT_ROWS = 8_192  # rows whose values of all trees meet in one group
PART_ROWS = 4_000_000  # rows that one part of a tree is given at most at once
_POISSON = np.cumsum(np.exp(-1.0) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320], dtype=float))
NODE = "tree int, code long, feature int, bin int, value array<double>, gain double"
PART = "tree int, code long, nodes binary"


def _weights(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) draws by a hash of (id, tree, seed)."""

    mix = (tree * 0x9E3779B97F4A7C15 + seed * 0xBF58476D1CE4E5B9 + 0x94D049BB133111EB) & (2**64 - 1)
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(mix)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return np.searchsorted(_POISSON, (x >> np.uint64(11)).astype(np.float64) / float(1 << 53), side="right").astype(np.float64)


def _sums(node: np.ndarray, bins: np.ndarray, stats: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """(nodes, bins, stats) sums of one feature."""

    at = node * width + bins
    return np.stack([np.bincount(at, weights=s, minlength=nodes * width).reshape(nodes, width) for s in stats], axis=2)


def _by_class(y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray | None]:
    """From rows of class and factor: the classes, and the factor of each class
    or None if rows of one class differ."""

    label, factor = y[:, 0].astype(np.int64), np.ones(classes)
    factor[label] = y[:, 1]
    return label, factor if (factor[label] == y[:, 1]).all() else None


def _class_sums(
    node: np.ndarray, bins: np.ndarray, label: np.ndarray, w: np.ndarray, factor: np.ndarray, fixed: np.ndarray | None, nodes: int, width: int, classes: int,
) -> np.ndarray:
    """``_sums`` of weight, the weight of each class, and rows drawn; ``fixed``:
    the factor of each class, if it has one only."""

    at = node * width + bins
    if fixed is not None:
        drawn = np.bincount(at * classes + label, weights=w, minlength=nodes * width * classes).reshape(nodes, width, classes)
        by = drawn * fixed
        return np.concatenate([by.sum(axis=2, keepdims=True), by, drawn.sum(axis=2, keepdims=True)], axis=2)
    by = np.bincount(at * classes + label, weights=w * factor, minlength=nodes * width * classes).reshape(nodes, width, classes)
    drawn = np.bincount(at, weights=w, minlength=nodes * width).reshape(nodes, width, 1)
    return np.concatenate([by.sum(axis=2, keepdims=True), by, drawn], axis=2)


def _best_splits(sums: np.ndarray, total: np.ndarray, min_leaf: float, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gain, bin) of each node's best split by one feature: rows of the bin and
    below go left. No split with ``min_leaf`` (of ``count`` by node and bin) on
    both sides has a gain of 0."""

    left = np.cumsum(sums[:, :-1], axis=1)
    right = total[:, None] - left
    n, m = left[..., 0], right[..., 0]
    least = np.cumsum(count[:, :-1], axis=1)
    rest = count.sum(axis=1)[:, None] - least
    with np.errstate(divide="ignore", invalid="ignore"):
        kept = (left[..., 1:] ** 2).sum(axis=2) / n + (right[..., 1:] ** 2).sum(axis=2) / m
        base = (total[:, 1:] ** 2).sum(axis=1) / total[:, 0]
    gain = np.where((least >= min_leaf) & (rest >= min_leaf), kept - base[:, None], 0.0)
    at = gain.argmax(axis=1) if gain.shape[1] else np.zeros(len(gain), dtype=np.int64)
    best = gain[np.arange(len(gain)), at] if gain.shape[1] else np.zeros(len(gain))
    return np.where(best > 1e-12 * np.maximum(1.0, np.abs(base)), best, 0.0), at


def _subset(codes: np.ndarray, tree: int, seed: int, dim: int, take: int) -> np.ndarray:
    """The features that each node may be split by, in order: ``take`` of them
    by a hash of node, tree and seed; all with 0."""

    if not 0 < take < dim:
        return np.tile(np.arange(dim), (len(codes), 1))
    mix = (tree * 0x94D049BB133111EB + seed * 0x9E3779B97F4A7C15 + 0xBF58476D1CE4E5B9) & (2**64 - 1)
    with np.errstate(over="ignore"):
        x = (codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(mix)) + np.arange(1, dim + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return np.sort(np.argpartition(x, take - 1, axis=1)[:, :take], axis=1)


def _splits(
    bins: np.ndarray, stats: np.ndarray, rows: np.ndarray, node: np.ndarray, feats: np.ndarray, total: np.ndarray, width: int, min_leaf: float, counted: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature, bin) of each node's best split, feature -1 where there is
    none; ``rows`` are in the order of their ``node``. A node of m rows holds at
    most m bins of a feature: nodes of like size are summed up together in that
    many places instead of ``width``."""

    nodes, k = feats.shape
    gain, feature, cut = np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, dtype=np.int64)
    m = np.bincount(node, minlength=nodes)
    begin = np.cumsum(m) - m
    places = np.minimum(1 << np.ceil(np.log2(np.maximum(m, 1))).astype(np.int64), width)
    able = (total[:, -1] if counted else total[:, 0]) >= 2 * min_leaf
    targets = len(stats) - 1 - counted
    for s in np.unique(places[able]).tolist():
        if s < 2:
            continue
        alike = np.flatnonzero(able & (places == s))
        step = max(1, CELLS // (k * s))
        for chunk in (alike[i: i + step] for i in range(0, len(alike), step)):
            mine, v = m[chunk], len(chunk) * k
            local = np.repeat(np.arange(len(chunk)), mine)
            r = rows[np.repeat(begin[chunk] - (np.cumsum(mine) - mine), mine) + np.arange(len(local))]
            cell = (local[:, None] * k + np.arange(k)) * width + bins[r[:, None], feats[chunk][local]]
            if s < width:
                here = np.zeros(v * width, dtype=bool)
                here[cell.ravel()] = True
                held = np.flatnonzero(here)
                owner = held // width
                at = np.empty(v * width, dtype=np.int64)
                at[held] = owner * s + np.arange(len(held)) - np.searchsorted(owner, np.arange(v))[owner]
                cell = at[cell]
                name = np.zeros(v * s, dtype=np.int64)
                name[at[held]] = held % width
            cell = cell.ravel()

            def left(j: int) -> np.ndarray:
                return np.cumsum(np.bincount(cell, weights=np.repeat(stats[j][r], k), minlength=v * s).reshape(v, s)[:, :-1], axis=1)  # noqa: B023

            whole = np.repeat(total[chunk], k, axis=0)
            n = left(0)
            o = whole[:, :1] - n
            below, above = np.zeros_like(n), np.zeros_like(n)
            for j in range(1, targets + 1):
                low = left(j)
                below += low**2
                above += (whole[:, j: j + 1] - low) ** 2
            least = left(len(stats) - 1) if counted else n
            rest = whole[:, -1:] - least if counted else o
            with np.errstate(divide="ignore", invalid="ignore"):
                base = (whole[:, 1: targets + 1] ** 2).sum(axis=1) / whole[:, 0]
                g = np.where((least >= min_leaf) & (rest >= min_leaf), below / n + above / o - base[:, None], 0.0)
            best = g.argmax(axis=1)
            g = g[np.arange(v), best]
            g = np.where(g > 1e-12 * np.maximum(1.0, np.abs(base)), g, 0.0).reshape(len(chunk), k)
            best = (name[np.arange(v) * s + best] if s < width else best).reshape(len(chunk), k)
            first, each = g.argmax(axis=1), np.arange(len(chunk))
            some = g[each, first] > 0
            gain[chunk[some]], cut[chunk[some]] = g[each, first][some], best[each, first][some]
            feature[chunk[some]] = feats[chunk][each, first][some]
    return gain, feature, cut


def _grow(
    bins: np.ndarray, y: np.ndarray, w: np.ndarray, width: int, depth: int, min_leaf: float, code: int = 1, newton: bool = False,
    count: np.ndarray | None = None, take: int = 0, tree: int = 0, seed: int = 0,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, feature, bin, value, gain) of the nodes of ``grow``. ``count``: what
    ``min_leaf`` speaks of, if not the weight; ``take``: see ``_subset``."""

    centre = (y * w[:, None]).sum(axis=0) / w.sum()
    targets = y.shape[1]
    stats = np.vstack([w, ((y - centre) * w[:, None]).T, *([] if count is None else [count])])
    at, codes = np.zeros(len(w), dtype=np.int64), np.array([code])
    rows, made = np.arange(len(w)), []
    for level in range(depth + 1):
        total = np.stack([np.bincount(at, weights=s[rows], minlength=len(codes)) for s in stats], axis=1)
        gain, feature, cut = np.zeros(len(codes)), np.full(len(codes), -1), np.zeros(len(codes), dtype=np.int64)
        if level < depth:
            gain, feature, cut = _splits(bins, stats, rows, at, _subset(codes, tree, seed, bins.shape[1], take), total, width, min_leaf, count is not None)
        mean = total[:, 1: targets + 1]
        if newton:
            curve = np.stack([np.bincount(at, weights=c[rows], minlength=len(codes)) for c in (np.abs(y) * (1 - np.abs(y)) * w[:, None]).T], axis=1)
            value = (mean + centre * total[:, :1]) / (curve + 1.0)
        else:
            value = mean / total[:, :1] + centre
        made.append((codes, feature, cut, value, gain))
        split = feature >= 0
        if not split.any():
            break
        place = np.cumsum(split) - 1
        on = split[at]
        rows, at = rows[on], at[on]
        new = 2 * place[at] + (bins[rows, feature[at]] > cut[at])
        by = np.argsort(new, kind="stable")
        rows, at = rows[by], new[by]
        codes = np.stack([2 * codes[split], 2 * codes[split] + 1], axis=1).ravel()
    return tuple(np.concatenate(part) for part in zip(*made, strict=True))


def _grow_classes(
    bins: np.ndarray, label: np.ndarray, w: np.ndarray, factor: np.ndarray, width: int, depth: int, min_leaf: float, code: int = 1, take: int = 0,
    tree: int = 0, seed: int = 0,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``_grow`` gives for the indicators of ``label``, rows drawn ``w`` times
    and weighing the ``factor`` of their class each. All sums are whole numbers by
    class, so one pass serves all classes and the order of rows does not matter."""

    classes, k = len(factor), take if 0 < take < bins.shape[1] else bins.shape[1]
    codes, sizes, made = np.array([code]), np.array([len(w)]), []
    total = np.bincount(label, weights=w, minlength=classes)[None]
    for level in range(depth + 1):
        nodes = len(codes)
        gain, feature, cut = np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes, dtype=np.int64)
        low = np.zeros((nodes, classes))
        ends = np.cumsum(sizes)
        if level < depth:
            feats = _subset(codes, tree, seed, bins.shape[1], take)
            able = np.flatnonzero((total.sum(axis=1) >= 2 * min_leaf) & ((total > 0).sum(axis=1) > 1))
            step = max(1, CELLS // (k * width * classes))
            for chunk in (able[i: i + step] for i in range(0, len(able), step)):
                sums = np.empty((len(chunk), k, width, classes))
                few = sizes[chunk] < 2048
                for c in np.flatnonzero(~few):
                    rows = slice(ends[chunk[c]] - sizes[chunk[c]], ends[chunk[c]])
                    for j, f in enumerate(feats[chunk[c]].tolist()):
                        sums[c, j] = np.bincount(bins[rows, f] * np.int64(classes) + label[rows], weights=w[rows], minlength=width * classes).reshape(width, classes)
                if few.any():
                    own = chunk[few]
                    mine = sizes[own]
                    local = np.repeat(np.arange(len(own)), mine)
                    r = np.repeat(ends[own] - np.cumsum(mine), mine) + np.arange(len(local))
                    cell = ((local[:, None] * k + np.arange(k)) * width + bins[r[:, None], feats[own][local]]) * classes + label[r][:, None]
                    sums[few] = np.bincount(cell.ravel(), weights=np.repeat(w[r], k), minlength=len(own) * k * width * classes).reshape(-1, k, width, classes)
                left = np.cumsum(sums[:, :, :-1], axis=2)
                least = left.sum(axis=3)
                rest = total[chunk].sum(axis=1)[:, None, None] - least
                whole = total[chunk] * factor
                n = whole.sum(axis=1)[:, None, None]
                mean = (whole / n[:, 0])[:, None, None]
                below = left * factor
                m = below.sum(axis=3)
                off = ((below - mean * m[..., None]) ** 2).sum(axis=3)  # from the node's shares; as much is on the other side
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where((least >= min_leaf) & (rest >= min_leaf) & (least > 0) & (rest > 0), off / m + off / (n - m), 0.0)
                g = np.where(g > 1e-12, g, 0.0).reshape(len(chunk), -1)
                best, each = g.argmax(axis=1), np.arange(len(chunk))
                first, at = np.divmod(best, width - 1)
                some = g[each, best] > 0
                on = chunk[some]
                gain[on], cut[on] = g[each, best][some], at[some]
                feature[on] = feats[chunk][each, first][some]
                low[on] = left[each, first, at][some]
        share = total * factor
        made.append((codes, feature, cut, share / share.sum(axis=1, keepdims=True), gain))
        split = feature >= 0
        if not split.any():
            break
        node = np.repeat(np.arange(nodes), sizes)
        rows = np.flatnonzero(split[node])
        node = node[rows]
        new = 2 * (np.cumsum(split) - 1)[node] + (bins[rows, feature[node]] > cut[node])
        if 2 * split.sum() < 1 << 16:
            new = new.astype(np.uint16)  # sorted by radix
        by = rows[np.argsort(new, kind="stable")]
        bins, label, w = bins[by], label[by], w[by]
        sizes = np.bincount(new, minlength=2 * split.sum())
        total = np.stack([low[split], total[split] - low[split]], axis=1).reshape(-1, classes)
        codes = np.stack([2 * codes[split], 2 * codes[split] + 1], axis=1).ravel()
    return tuple(np.concatenate(part) for part in zip(*made, strict=True))


def grow(
    bins: np.ndarray, y: np.ndarray, w: np.ndarray, width: int, depth: int, min_leaf: float, code: int = 1, newton: bool = False,
) -> list[tuple]:
    """The nodes (code, feature, bin, value) of the tree below ``code`` over all
    rows given; leaves have feature -1. The children of c are 2c and 2c + 1. A
    value is the mean of y, or with ``newton`` (y: indicator minus probability)
    the sum of y over that of its curvature plus one."""

    return [(int(c), int(f), int(b), v) for c, f, b, v, _ in zip(*_grow(bins, y, w, width, depth, min_leaf, code, newton), strict=True)]


def add_trees(bins: np.ndarray, trees: Sequence[tuple], total: np.ndarray) -> np.ndarray:
    """``total`` plus every tree's value for each row."""

    flat, first = np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
    for feature, cut, child, value in trees:
        at = np.zeros(len(bins), dtype=np.int64)
        if len(feature) <= len(bins):  # a node as one number: child, feature, bin; a leaf is its own child
            leaf = feature < 0
            below = np.where(leaf, np.arange(len(feature)), child.astype(np.int64))
            node = below << 32 | np.where(leaf, 0, feature.astype(np.int64)) << 16 | np.where(leaf, 0xFFFF, cut.astype(np.int64))
            front = np.zeros(1, dtype=np.int64)
            while len(front := front[~leaf[front]]):
                for i in range(0, len(bins), 16384):
                    own = node[at[i: i + 16384]]
                    at[i: i + 16384] = (own >> 32) + (flat[first[i: i + 16384] + (own >> 16 & 0xFFFF)] > (own & 0xFFFF))
                front = np.concatenate([below[front], below[front] + 1])
        else:
            rows = np.arange(len(bins))
            while len(rows):
                rows = rows[feature[at[rows]] >= 0]
                node = at[rows]
                at[rows] = child[node] + (bins[rows, feature[node]] > cut[node])
        total = total + value[at]
    return total


def _top(splits: dict[int, tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The splits of one tree's large nodes as sorted arrays: codes, features,
    bins. Plain arrays, since a broadcast object needs its class on the executors."""

    codes = np.array(sorted(splits), dtype=np.int64)
    return codes, *(np.array([splits[c][i] for c in codes.tolist()], dtype=np.int64) for i in (0, 1))


def _place(top: tuple[np.ndarray, np.ndarray, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """The code of the node that each row has come to."""

    codes, feature, cut = top
    code = np.ones(len(bins), dtype=np.int64)
    rows = np.arange(len(bins))
    if len(codes) and 2 * codes[-1] + 2 <= len(bins):  # few codes: looked up by number
        by, above = np.full(2 * codes[-1] + 2, -1), np.zeros(2 * codes[-1] + 2, dtype=np.int64)
        by[codes], above[codes] = feature, cut
        flat, now, first = bins.ravel(), code, rows * bins.shape[1]
        while len(now):
            f = by[now]
            on = f >= 0
            if not on.all():
                code[rows[~on]] = now[~on]
                rows, now, first, f = rows[on], now[on], first[on], f[on]
            now = 2 * now + (flat[first + f] > above[now])
        return code
    while len(codes) and len(rows):
        i = np.minimum(np.searchsorted(codes, code[rows]), len(codes) - 1)
        on = codes[i] == code[rows]
        rows, i = rows[on], i[on]
        code[rows] = 2 * code[rows] + (bins[rows, feature[i]] > cut[i])
    return code


def packed(column: pa.Array, size: int) -> np.ndarray:
    """Binary values of ``size`` bytes each, none null, as rows of bytes; not copied."""

    if not len(column):
        return np.zeros((0, size), dtype=np.uint8)
    offsets, data = column.buffers()[1:3]
    first = np.frombuffer(offsets, dtype=np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset]
    return np.frombuffer(data, dtype=np.uint8, count=len(column) * size, offset=int(first)).reshape(len(column), size)


class Plain:
    """Rows as they are, drawn by Poisson weights. ``rows`` gives a batch's ids,
    bins and what is sent on of each row; ``targets`` makes of that the targets
    and a factor of the weights, or None."""

    newton = False
    counted = False  # least rows of a leaf: by weight, or by rows drawn
    take = 0

    def __init__(self, features: int, seed: int):
        self.features, self.seed = features, seed

    def rows(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        y = batch.column("y").flatten().to_numpy().reshape(batch.num_rows, -1)
        return batch.column("u").to_numpy(), packed(batch.column("bins"), self.features), y

    def targets(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        return y, None

    def draw(self, ids: np.ndarray, tree: int) -> np.ndarray:
        return _weights(ids, tree, self.seed)

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """``rows`` of many batches together."""

        held: list[tuple] = []
        for batch in batches:
            if batch.num_rows:
                held.append(self.rows(batch))
            if sum(len(h[0]) for h in held) >= BLOCK_ROWS:
                yield tuple(np.concatenate(part) for part in zip(*held, strict=True))
                held = []
        if held:
            yield tuple(np.concatenate(part) for part in zip(*held, strict=True))


class Classes(Plain):
    """Rows sent on as class and weight, whose targets are the classes'
    indicators: what a split takes off their squared errors is the Gini impurity
    it takes off. A node is split by one of ``take`` features."""

    counted = True

    def __init__(self, features: int, seed: int, classes: int, take: int):
        super().__init__(features, seed)
        self.classes, self.take = classes, take

    def targets(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        return np.eye(self.classes)[y[:, 0].astype(np.int64)], y[:, 1]


def read_bins(rows: DataFrame, features: Sequence[str], scratch: Scratch, extra: Sequence = (), most: int = BINS) -> tuple[DataFrame, list[np.ndarray], int]:
    """(table, edges, width): rows (u, bins and the columns ``extra``) with one
    byte per feature, the bin edges, and the largest number of bins."""

    edges = [np.unique(q) for q in rows.approxQuantile(list(features), [i / most for i in range(1, most)], 1 / (8 * most))]
    dim, width = len(features), max(len(e) for e in edges) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, dim)
            bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)
            rest = [c for c in batch.schema.names if c not in ("u", "x")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), pa.array([b.tobytes() for b in bins], pa.binary()), *(batch.column(c) for c in rest)], names=["u", "bins", *rest])

    plain = scratch.write(rows.select(F.monotonically_increasing_id().alias("u"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"), *extra), "rows")
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in plain.schema.fields if f.name not in ("u", "x"))
    dealt = plain.repartition(rows.sparkSession.sparkContext.defaultParallelism)  # every pass over the trees keeps all cores busy
    return scratch.write(dealt.mapInArrow(pack, f"u long, bins binary{kinds}"), "binned"), edges, width


def _node(targets: int) -> np.dtype:
    """A node of a PART row, whose nodes are in the order of their codes."""

    return np.dtype([("code", "i8"), ("feature", "i2"), ("bin", "i2"), ("value", "f8", (targets,))])


class Forest:
    """Bin edges by feature, the splits of the trees' large nodes, and a table of
    PART rows: the nodes at and below ``code``. A leaf's feature is -1."""

    def __init__(self, edges: list[np.ndarray], top: dict[int, dict[int, tuple]], parts: DataFrame, targets: Sequence[str]):
        self.edges, self.top, self.parts, self.targets = edges, top, parts, list(targets)

    @property
    def trees(self) -> list[tuple]:
        """All trees as arrays, node 0 being the root: for models that a driver holds."""

        targets = len(self.targets)
        kind = _node(targets)

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, nodes in zip(batch.column("tree").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
                    rows = np.frombuffer(nodes, dtype=kind)
                    ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * targets)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), tree, dtype=np.int32)), pa.array(rows["code"].copy()), pa.array(rows["feature"].astype(np.int32)),
                         pa.array(rows["bin"].astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(rows["value"].ravel())),
                         pa.array(np.zeros(len(rows)))], names=["tree", "code", "feature", "bin", "value", "gain"])

        return read_trees(_with_top(self.parts.mapInArrow(unpack, NODE), self.top), targets)

    def predict(self, rows: DataFrame, features: Sequence[str], outputs: Sequence[str]) -> DataFrame:
        """``rows`` with a column for each target, the mean over the trees in
        their order; no feature is null. Both are written once."""

        spark, dim, targets, edges = rows.sparkSession, len(features), len(self.targets), self.edges
        scratch = Scratch(spark, "predict")
        given = scratch.write(rows.select("*", F.monotonically_increasing_id().alias("_u"), F.array(*[F.col(c).cast("double") for c in features]).alias("_x")), "rows")
        shared = spark.sparkContext.broadcast({t: _top(s) for t, s in self.top.items()})
        kind = _node(targets)

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, PREDICT_ROWS):
                    part = batch.slice(at, PREDICT_ROWS)
                    ids, x = part.column("_u").to_numpy(), part.column("_x").flatten().to_numpy().reshape(part.num_rows, dim)
                    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)
                    for t, place in shared.value.items():
                        code = _place(place, bins)
                        by = np.argsort(code, kind="stable")
                        ends = np.flatnonzero(np.r_[np.diff(code[by]) != 0, True]) + 1
                        spans = list(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(ends), t, dtype=np.int32)), pa.array(code[by[ends - 1]]), pa.array(np.full(len(ends), ids[0])),
                             pa.array([ids[by[a:b]].tobytes() for a, b in spans], pa.binary()), pa.array([bins[by[a:b]].tobytes() for a, b in spans], pa.binary())],
                            names=["tree", "code", "block", "ids", "bins"])

        def fall(key: tuple, parts: pa.Table, visits: pa.Table) -> pa.Table:
            values = []
            if len(parts):  # a tree for which no row was drawn has none
                nodes = np.frombuffer(parts.column("nodes")[0].as_py(), dtype=kind)
                feature = nodes["feature"].astype(np.int64)
                child = np.where(feature >= 0, np.searchsorted(nodes["code"], 2 * nodes["code"]), 0)
                tree = (feature, nodes["bin"].astype(np.int64), child, nodes["value"])
                for b in visits.column("bins").to_pylist():
                    bins = np.frombuffer(b, dtype=np.uint8).reshape(-1, dim)
                    values.append(add_trees(bins, [tree], np.zeros((len(bins), targets))).tobytes())
            kept = visits.slice(0, len(values))
            return pa.table({"block": kept.column("block"), "tree": kept.column("tree"), "ids": kept.column("ids"), "values": pa.array(values, pa.binary())})

        def mean(key: tuple, found: pa.Table) -> pa.Table:
            tree = found.column("tree").to_numpy()
            ids = [np.frombuffer(i, dtype=np.int64) for i in found.column("ids").to_pylist()]
            own = np.sort(np.concatenate([i for i, t in zip(ids, tree.tolist(), strict=True) if t == tree[0]]))  # every tree has each row once
            total = np.zeros((len(own), targets))
            for k in np.argsort(tree, kind="stable").tolist():  # always added up in one order
                total[np.searchsorted(own, ids[k])] += np.frombuffer(found.column("values")[k].as_py()).reshape(-1, targets)
            total /= len(np.unique(tree))
            return pa.table({"_u": own, **{f"_p{j}": total[:, j] for j in range(targets)}})

        deal = max(1, -(-given.count() // PART_ROWS))
        visits = given.select("_u", "_x").mapInArrow(visit, "tree int, code long, block long, ids binary, bins binary").withColumn(
            "deal", F.expr(f"pmod(xxhash64(block), {deal}L)"))
        parts = self.parts.withColumn("deal", F.explode(F.expr(f"sequence(0L, {deal - 1}L)")))
        keys = ["tree", "code", "deal"]
        found = parts.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(fall, "block long, tree int, ids binary, values binary")
        made = scratch.write(found.groupBy("block").applyInArrow(mean, "_u long" + "".join(f", _p{j} double" for j in range(targets))), "values")
        return scratch.write(given.join(made, "_u").select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"_p{j}").alias(o) for j, o in enumerate(outputs)]), "predicted")


def fit_forest(
    rows: DataFrame, features: Sequence[str], targets: Sequence[str], trees: int = 80, max_depth: int = 18, min_leaf: int = 5,
    seed: int = 42, local_rows: int = LOCAL_ROWS,
) -> Forest:
    """A forest of bagged trees for all ``targets`` together; features and
    targets are doubles without nulls, and there is at least one row."""

    scratch = Scratch(rows.sparkSession, "trees")
    y = F.array(*[F.col(c).cast("double") for c in targets]).alias("y")
    table, edges, width = read_bins(rows, features, scratch, [y])
    source = Plain(len(features), seed)
    n = table.count()
    wave = max(1, min(trees, WAVE_ROWS // max(n, 1)))
    parts, tops = None, {}
    for first in range(0, trees, wave):
        grown, top = _grown(table, range(first, min(first + wave, trees)), n, source, width, len(targets), max_depth, min_leaf, local_rows, PART)
        made = scratch.write(grown, "wave")
        parts = made if parts is None else parts.unionByName(made)
        tops |= top
    return Forest(edges, tops, parts, targets)


def read_trees(nodes: DataFrame, targets: int) -> list[tuple]:
    """The trees of NODE rows, in their order, as arrays."""

    found = nodes.select("tree", "code", "feature", "bin", F.when(F.col("feature") < 0, F.col("value")).alias("value")).toArrow().combine_chunks()
    tree, code, feature, cut = (found.column(c).to_numpy() for c in ("tree", "code", "feature", "bin"))
    value = np.zeros((len(tree), targets))
    held = found.column("value").combine_chunks()
    value[feature < 0] = (held.chunk(0) if isinstance(held, pa.ChunkedArray) else held).flatten().to_numpy().reshape(-1, targets)
    by = np.lexsort((code, tree))  # a tree's codes in order: level by level, children side by side
    tree, code, feature, cut, value = tree[by], code[by], feature[by].astype(np.int64), cut[by].astype(np.int64), value[by]
    ends = np.flatnonzero(np.r_[tree[1:] != tree[:-1], True]) + 1 if len(tree) else []
    out, at = [], 0
    for end in ends:
        own = code[at:end]
        child = np.where(feature[at:end] >= 0, np.searchsorted(own, 2 * own), 0)
        out.append((feature[at:end], cut[at:end], child, value[at:end]))
        at = end
    return out


def gains(nodes: DataFrame, features: int) -> np.ndarray:
    """What the splits by each feature take off the errors: a tree's shares, and
    their mean over the trees."""

    total = np.zeros(features)
    by_tree: dict[int, np.ndarray] = {}
    for r in nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect():  # a row per tree and feature
        by_tree.setdefault(r["tree"], np.zeros(features))[r["feature"]] = r["gain"]
    for t in sorted(by_tree):
        total += by_tree[t] / by_tree[t].sum()
    return total / total.sum() if by_tree else total


def grow_wave(
    table: DataFrame, trees: range, n: int, source: Plain, width: int, targets: int, max_depth: int, min_leaf: int, local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """NODE rows of the trees over a table of ``n`` rows; ``source`` says what a
    batch's ids, bins and targets are and how rows are drawn for a tree."""

    return _with_top(*_grown(table, trees, n, source, width, targets, max_depth, min_leaf, local_rows))


def _with_top(nodes: DataFrame, top: dict[int, dict[int, tuple]]) -> DataFrame:
    """``nodes`` and the splits that the driver knows, as NODE rows."""

    upper = [(t, c, f, b, [], g) for t, s in top.items() for c, (f, b, g) in s.items()]
    return nodes.unionByName(nodes.sparkSession.createDataFrame(upper, NODE)) if upper else nodes


def _grown(
    table: DataFrame, trees: range, n: int, source: Plain, width: int, targets: int, max_depth: int, min_leaf: int, local_rows: int, out: str = NODE,
) -> tuple[DataFrame, dict[int, dict[int, tuple]]]:
    """The nodes finished by one task each, as NODE or PART rows, and the splits
    (feature, bin, gain) of the larger ones by tree and code."""

    dim, sent = source.features, 2 if source.counted else targets
    top: dict[int, dict[int, tuple[int, int, float]]] = {t: {} for t in trees}
    large = [(t, 1) for t in trees] if n > local_rows else []
    while large:
        now, large = large[:NODES_PER_PASS], large[NODES_PER_PASS:]
        for t, code, f, b, low, high, g in _level(table, top, now, source, width, targets, min_leaf):
            if f >= 0:
                top[t][code] = (f, b, g)
                deeper = (2 * code).bit_length() - 1 < max_depth
                large += [(t, c) for c, rows in ((2 * code, low), (2 * code + 1, high)) if rows > local_rows and deeper]
    places = {t: _top(s) for t, s in top.items()}
    shared = table.sparkSession.sparkContext.broadcast(places)

    kept = np.dtype([("w", "u1"), ("bins", "u1", (dim,)), ("y", "f8", (sent,))])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bins, y in source.blocks(batches):
            for t, place in shared.value.items():
                w = source.draw(ids, t)
                took = np.flatnonzero(w)
                if not len(took):
                    continue
                code = _place(place, bins[took])
                by = np.argsort(code, kind="stable")
                took, code = took[by], code[by]
                rows = np.empty(len(took), dtype=kept)
                rows["w"], rows["bins"], rows["y"] = w[took], bins[took], y[took]
                ends = np.flatnonzero(np.r_[code[1:] != code[:-1], True]) + 1
                blocks = [rows[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), t, dtype=np.int32)), pa.array(code[ends - 1]), pa.array(blocks, pa.binary())], names=["tree", "code", "rows"])

    def finish(key: tuple, given: pa.Table) -> pa.Table:
        code = key[1].as_py()
        rows = np.frombuffer(b"".join(given.column("rows").to_pylist()), dtype=kept)
        bins, y, w = np.ascontiguousarray(rows["bins"]), np.ascontiguousarray(rows["y"]), rows["w"].astype(np.float64)
        down = max_depth - (code.bit_length() - 1)
        if source.counted and len(w) > BLOCK_ROWS:
            label, fixed = _by_class(y, source.classes)
            if fixed is not None:
                return _nodes(key, _grow_classes(bins, label, w, fixed, width, down, min_leaf, code, source.take, key[0].as_py(), source.seed), out)
        wide = np.zeros((len(bins), -(-dim // 8) * 8), dtype=np.uint8)  # eight bins as one number, the last bin first
        wide[:, wide.shape[1] - dim:] = bins
        words = np.ascontiguousarray(wide[:, ::-1]).view(">u8").astype(np.uint64)
        by = np.lexsort((*y.T, *words.T[::-1], w))  # the order in which rows arrive does not matter
        bins, w = bins[by], w[by]
        y, factor = source.targets(y[by])
        return _nodes(key, _grow(
            bins, y, w if factor is None else w * factor, width, down, min_leaf, code, source.newton,
            w if source.counted else None, source.take, key[0].as_py(), source.seed), out)

    return table.mapInArrow(deal, "tree int, code long, rows binary").groupBy("tree", "code").applyInArrow(finish, out), top


def _nodes(key: tuple, grown: tuple[np.ndarray, ...], out: str) -> pa.Table:
    """What ``_grow`` gave below the node ``key`` (tree, code), as NODE or PART rows."""

    codes, feature, cut, value, gain = grown
    if out == PART:
        nodes = np.empty(len(codes), dtype=_node(value.shape[1]))
        nodes["code"], nodes["feature"], nodes["bin"], nodes["value"] = codes, feature, cut, value
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()), "code": pa.array([key[1].as_py()], pa.int64()), "nodes": pa.array([nodes.tobytes()], pa.binary())})
    ends = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * value.shape[1])
    return pa.table({
        "tree": pa.array(np.full(len(codes), key[0].as_py(), dtype=np.int32)), "code": pa.array(codes.astype(np.int64)),
        "feature": pa.array(feature.astype(np.int32)), "bin": pa.array(cut.astype(np.int32)),
        "value": pa.ListArray.from_arrays(ends, pa.array(value.ravel())), "gain": pa.array(gain)})


def _level(table: DataFrame, top: dict, now: list, source: Plain, width: int, targets: int, min_leaf: int) -> list[tuple]:
    """(tree, code, feature, bin, rows left, rows right, gain) for the nodes
    ``now``; feature -1 where no split is left."""

    dim = source.features
    wanted: dict[int, list[int]] = {}
    for t, code in now:
        wanted.setdefault(t, []).append(code)
    shared = table.sparkSession.sparkContext.broadcast({t: (_top(top[t]), np.array(sorted(codes))) for t, codes in wanted.items()})

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for ids, bins, y in source.blocks(batches):
            given = y
            if source.counted:
                label, fixed = _by_class(y, targets)
            else:
                y, factor = source.targets(y)
            for t, (place, codes) in shared.value.items():
                w = source.draw(ids, t)
                took = np.flatnonzero(w)
                code = _place(place, bins[took])
                at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                here = codes[at] == code
                on, at = took[here], at[here]
                if len(on):
                    own = bins[on[:, None], _subset(codes, t, source.seed, dim, source.take)[at]].astype(np.int64)
                    if source.counted:  # one sum by class serves all classes
                        new = np.stack([_class_sums(at, own[:, f], label[on], w[on], given[on, 1], fixed, len(codes), width, targets) for f in range(own.shape[1])], axis=1)
                    else:
                        weight = w[on] if factor is None else w[on] * factor[on]
                        stats = np.vstack([weight, (y[on] * weight[:, None]).T])
                        new = np.stack([_sums(at, own[:, f], stats, len(codes), width) for f in range(own.shape[1])], axis=1)
                    held[t] = held[t] + new if t in held else new
        for t, sums in held.items():
            codes = shared.value[t][1]
            seen = np.flatnonzero(sums[:, 0, :, 0].any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), t, dtype=np.int32)), pa.array(codes[seen]), pa.array([sums[i].tobytes() for i in seen], pa.binary())], names=["tree", "code", "sums"])

    def choose(key: tuple, rows: pa.Table) -> pa.Table:
        parts = sorted(rows.column("sums").to_pylist())  # always added up in one order
        feats = _subset(np.array([key[1].as_py()]), key[0].as_py(), source.seed, dim, source.take)[0]
        sums = sum(np.frombuffer(p).reshape(len(feats), width, targets + 1 + source.counted) for p in parts)
        total = sums[0].sum(axis=0)
        count = sums[..., -1] if source.counted else sums[..., 0]
        mean = total[1: targets + 1] / total[0]
        sums = np.concatenate([sums[..., :1], sums[..., 1: targets + 1] - sums[..., :1] * mean], axis=2)  # centred, so that gains do not cancel out
        best, f, b, low = 0.0, -1, 0, 0.0
        for i, each in enumerate(feats.tolist()):
            gain, cut = _best_splits(sums[i: i + 1], sums[i].sum(axis=0)[None, :], min_leaf, count[i: i + 1])
            if gain[0] > best:
                best, f, b = float(gain[0]), each, int(cut[0])
                low = float(count[i, : b + 1].sum())
        whole = float(count[0].sum())
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()), "code": pa.array([key[1].as_py()], pa.int64()), "feature": pa.array([f], pa.int32()),
                         "bin": pa.array([b], pa.int32()), "low": pa.array([low]), "high": pa.array([whole - low]), "gain": pa.array([best])})

    found = table.mapInArrow(partial, "tree int, code long, sums binary").groupBy("tree", "code").applyInArrow(
        choose, "tree int, code long, feature int, bin int, low double, high double, gain double")
    return [tuple(r) for r in found.collect()]
