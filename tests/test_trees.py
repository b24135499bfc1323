"""Multi-target trees: splits against brute force, levels against local growth."""

import numpy as np
import pyarrow as pa

from wakeline.plans import trees as T


def data(n=900, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 10, (n, 3)), 1)
    y = np.stack([np.sin(x[:, 0]) * 5 + x[:, 1], np.where(x[:, 1] > 5, 8.0, -8.0) + 0.1 * x[:, 0]], axis=1) + rng.normal(0, 0.05, (n, 2))
    return x, y


def frame(spark, x, y):
    rows = [(*map(float, a), *map(float, b), "k") for a, b in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, y1 double, y2 double, u string").repartition(3)


def test_root_split_is_the_best_of_all():
    x, y = data(200)
    bins = (x * 10).astype(np.int64)
    nodes = {c: (f, b) for c, f, b, _ in T.grow(bins, y, np.ones(200), 101, 1, 5)}
    best = max(
        (((y[left].mean(axis=0) - y.mean(axis=0)) ** 2).sum() * left.sum() + ((y[~left].mean(axis=0) - y.mean(axis=0)) ** 2).sum() * (~left).sum(), f, b)
        for f in range(3) for b in range(100) for left in [bins[:, f] <= b] if 5 <= left.sum() <= 195)
    f, b = nodes[1]
    assert f == best[1] and (bins[:, f] <= b).sum() == (bins[:, f] <= best[2]).sum()
    assert all(nodes[c][0] == -1 for c in (2, 3))


def test_leaves_hold_means_and_least_rows():
    x, y = data(300)
    bins = (x * 10).astype(np.int64)
    nodes = {c: (f, b, v) for c, f, b, v in T.grow(bins, y, np.ones(300), 101, 6, 7)}
    code = np.ones(300, dtype=int)
    for _ in range(7):
        code = np.array([2 * c + (bins[i, nodes[c][0]] > nodes[c][1]) if nodes[c][0] >= 0 else c for i, c in enumerate(code)])
    for c in set(code.tolist()):
        assert (code == c).sum() >= 7 and np.allclose(nodes[c][2], y[code == c].mean(axis=0))


def test_levels_give_the_trees_of_one_task(spark):
    x, y = data()
    rows = frame(spark, x, y)
    kw = dict(trees=4, max_depth=6, min_leaf=5)
    one, many = (T.fit_forest(rows, ["a", "b", "c"], ["y1", "y2"], local_rows=k, **kw) for k in (100_000, 120))
    for a, b in zip(one.trees, many.trees, strict=True):
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and np.allclose(a[3], b[3])
    assert len({a[0].tobytes() + a[1].tobytes() for a in one.trees}) == 4  # trees draw differently


def test_predictions_fit_and_keep_columns(spark):
    x, y = data()
    rows = frame(spark, x, y)
    forest = T.fit_forest(rows, ["a", "b", "c"], ["y1", "y2"], trees=20, max_depth=10)
    out = forest.predict(rows, ["a", "b", "c"], ["p1", "p2"])
    assert out.columns == [*rows.columns, "p1", "p2"]
    got = out.toPandas()
    for t, p in ((got.y1, got.p1), (got.y2, got.p2)):
        assert ((t - p) ** 2).mean() < 0.01 * t.var()
    assert forest.predict(rows.limit(0), ["a", "b", "c"], ["p1", "p2"]).count() == 0


def test_one_row_and_constant_features(spark):
    rows = frame(spark, np.ones((1, 3)), np.array([[2.0, 3.0]]))
    out = T.fit_forest(rows, ["a", "b"], ["y1", "y2"], trees=12).predict(rows, ["a", "b"], ["p1", "p2"]).first()
    assert (out.p1, out.p2) == (2.0, 3.0)


def test_a_forest_stays_in_its_table(spark, monkeypatch):
    # parts of trees meet the rows by tree and code; no tree comes to the driver, however the rows are dealt
    x, y = data()
    rows = frame(spark, x, y)
    forest = T.fit_forest(rows, ["a", "b", "c"], ["y1", "y2"], trees=5, max_depth=8, local_rows=150)
    trees = forest.trees
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(forest.edges)], axis=1)
    want = T.add_trees(bins, trees, np.zeros((len(x), 2))) / len(trees)
    whole = sorted((*map(float, a), *map(float, p)) for a, p in zip(x, want, strict=True))
    monkeypatch.setattr(T, "read_trees", None)
    for block, part in ((8192, 4_000_000), (70, 200)):
        monkeypatch.setattr(T, "PREDICT_ROWS", block)
        monkeypatch.setattr(T, "PART_ROWS", part)
        got = forest.predict(rows, ["a", "b", "c"], ["p1", "p2"]).collect()
        assert sorted((r.a, r.b, r.c, r.p1, r.p2) for r in got) == whole
    assert max(len(p.nodes) for p in forest.parts.collect()) < 150 * T._node(2).itemsize


def test_packed_rows_are_not_copied():
    rows = np.arange(60, dtype=np.uint8).reshape(20, 3)
    for kind in (pa.binary(), pa.large_binary()):
        column = pa.array([r.tobytes() for r in rows], kind)
        for at, n in ((0, 20), (7, 5), (20, 0)):
            got = T.packed(column.slice(at, n), 3)
            assert (got == rows[at: at + n]).all() and got.shape == (n, 3)
        at = T.packed(column, 3).__array_interface__["data"][0]
        assert at == column.buffers()[2].address


def test_rows_fall_through_nodes_as_one_number():
    # each level gathered six arrays of a node; the values are the same to the last bit, whatever the arrays' types
    rng = np.random.default_rng(21)
    bins = rng.integers(0, 256, (700, 5)).astype(np.uint8)
    nodes = T.grow(bins, rng.normal(size=(700, 2)), np.ones(700), 256, 9, 3)
    nodes.sort(key=lambda n: n[0])
    code = np.array([n[0] for n in nodes])
    feature, cut = np.array([n[1] for n in nodes]), np.array([n[2] for n in nodes])
    child = np.where(feature >= 0, np.searchsorted(code, 2 * code), 0)
    value = np.array([n[3] for n in nodes])
    tree, small = (feature, cut, child, value), (feature.astype(np.int16), cut.astype(np.int16), child.astype(np.int32), value)
    leaf = (np.full(1, -1), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), np.ones((1, 2)))
    many = T.add_trees(bins, [tree, leaf, small], np.zeros((700, 2)))
    few = np.concatenate([T.add_trees(bins[i: i + 20], [tree, leaf, small], np.zeros((20, 2))) for i in range(0, 700, 20)])
    assert len(nodes) > 20 and (many == few).all() and (T.add_trees(bins.astype(np.int64), [tree, leaf, tree], np.zeros((700, 2))) == many).all()
