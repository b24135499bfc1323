"""The binned forest classifier: Gini splits, weights, importances, levels against one task, memory."""

import pickle
import random
import tracemalloc

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from wakeline.plans import forests as FO
from wakeline.plans import trees as T


def gini_root(x, label, weight, least):
    """The best (gain, feature, threshold) of one node by brute force."""

    def impurity(on):
        w = np.bincount(label[on], weights=weight[on])
        return w.sum() - (w**2).sum() / w.sum()

    every = np.ones(len(x), dtype=bool)
    return max((impurity(every) - impurity(x[:, f] <= c) - impurity(x[:, f] > c), f, c)
               for f in range(x.shape[1]) for c in np.unique(x[:, f])[:-1] if least <= (x[:, f] <= c).sum() <= len(x) - least)


def test_splits_are_those_of_weighted_gini():
    rng = np.random.default_rng(3)
    x, label = rng.integers(0, 40, (200, 4)), rng.integers(0, 3, 200)
    label[x[:, 2] > 25] = 1
    weight = np.array([1.0, 0.3, 2.0])[label]
    code, feature, cut, _, gain = T._grow(x.astype(np.uint8), np.eye(3)[label], weight, 64, 1, 7, count=np.ones(200))
    best = gini_root(x, label, weight, 7)
    assert (code[0], feature[0]) == (1, best[1]) and abs(gain[0] - best[0]) < 1e-9
    assert ((x[:, best[1]] <= cut[0]) == (x[:, best[1]] <= best[2])).all()


def test_splits_sent_to_tasks_need_no_package():
    # a broadcast is pickled by reference to its classes, and executors may not have them
    top = T._top({2: (1, 0, 0.5), 1: (0, 3, 1.0)})
    assert b"wakeline" not in pickle.dumps(top)
    assert T._place(top, np.array([[9, 0], [3, 0], [0, 1]], dtype=np.uint8)).tolist() == [3, 4, 5]


def test_a_level_needs_no_sums_of_nodes_times_bins():
    # 12,000 rows in some 1,000 nodes: before, each feature's sums held every node's 256 bins (17 MB)
    rng = np.random.default_rng(5)
    bins, y = rng.integers(0, 256, (12_000, 4)).astype(np.uint8), rng.normal(size=(12_000, 6))
    tracemalloc.start()
    made = T.grow(bins, y, np.ones(12_000), 256, 18, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(made) > 1000 and peak < 10e6


def frame(spark, n=600):
    rng = random.Random(9)
    rows = []
    for _ in range(n):
        a, b, c = rng.uniform(0, 1), rng.uniform(0, 1), rng.uniform(0, 1)
        k = 0 if a < 0.3 else 1 if b < 0.5 else 2
        rows.append((a, b, c, float("nan") if rng.random() < 0.1 else rng.uniform(0, 1), float(k), 2.0 if k == 0 else 1.0))
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features", handleInvalid="keep").transform(
        spark.createDataFrame(rows, "a double, b double, c double, d double, label double, weight double").repartition(3))


def test_forest_learns_and_saves(spark, tmp_path):
    rows = frame(spark)
    model = Pipeline(stages=[FO.ForestClassifier(numTrees=15, maxDepth=6)]).fit(rows)
    out = model.transform(rows).select("label", "prediction", vector_to_array("probability").alias("p")).collect()
    assert len(out) == 600 and sum(r.label == r.prediction for r in out) > 580
    assert all(abs(sum(r.p) - 1) < 1e-9 and r.p[int(r.prediction)] == max(r.p) for r in out)
    shares = model.stages[0].featureImportances.toArray()
    assert abs(shares.sum() - 1) < 1e-9 and min(shares[0], shares[1]) > 3 * max(shares[2], shares[3])
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(rows)
    assert sorted(r.prediction for r in again.collect()) == sorted(r.prediction for r in out)


def test_levels_give_the_classifier_of_one_task(spark, monkeypatch):
    # equally good splits of a small node may fall either way, so shares are compared and not trees
    rows = frame(spark)
    found = []
    for local in (100_000, 100):
        monkeypatch.setattr(FO, "LOCAL_ROWS", local)
        found.append(FO.ForestClassifier(numTrees=4, maxDepth=5, minInstancesPerNode=3).fit(rows))
    for a, b in zip(*(f.state[1] for f in found), strict=True):
        assert (a[0][0], a[1][0]) == (b[0][0], b[1][0])
    assert np.allclose(found[0].state[3], found[1].state[3], atol=0.01)
    one, many = ([r.prediction for r in f.transform(rows).orderBy("a", "b", "c").collect()] for f in found)
    assert np.mean(np.array(one) == np.array(many)) > 0.98


def test_one_class_and_one_row(spark):
    row = frame(spark, 1).limit(1)
    out = FO.ForestClassifier(numTrees=30).fit(row).transform(row).first()
    assert out.prediction == out.label


def test_sums_by_class_give_the_same_tree():
    # before, every class had sums of its own over all rows: with 14 classes 16 passes a feature
    rng = np.random.default_rng(11)
    n, classes = 3000, 14
    bins, label, w = rng.integers(0, 64, (n, 6)).astype(np.uint8), rng.integers(0, classes, n), rng.poisson(1, n) + 1.0
    label[bins[:, 2] > 40] = 5
    label[(bins[:, 4] > 30) & (label < 7)] = 9
    factor = rng.uniform(0.3, 3, classes)
    for take, least, first in ((0, 20, 1), (3, 6, 5)):
        want = T._grow(bins, np.eye(classes)[label], w * factor[label], 64, 7, least, first, count=w, take=take, tree=2, seed=42)
        got = T._grow_classes(bins, label, w, factor, 64, 7, least, first, take=take, tree=2, seed=42)
        assert len(got[0]) > 15 and all((a == b).all() for a, b in zip(got[:3], want[:3], strict=True))
        assert np.allclose(got[3], want[3]) and np.allclose(got[4], want[4])


def test_sums_by_class_of_a_level():
    rng = np.random.default_rng(12)
    node, bins, label, w = rng.integers(0, 3, 500), rng.integers(0, 8, 500), rng.integers(0, 4, 500), rng.poisson(1, 500) + 1.0
    factor = np.array([1.0, 0.5, 2.0, 3.0])[label]
    want = T._sums(node, bins, np.vstack([w * factor, (np.eye(4)[label] * (w * factor)[:, None]).T, w]), 3, 8)
    one, fixed = T._by_class(np.stack([label, factor], axis=1), 5)
    assert (one == label).all() and fixed.tolist() == [1.0, 0.5, 2.0, 3.0, 1.0]
    assert T._by_class(np.array([[1, 2.0], [1, 3.0]]), 2)[1] is None
    for known in (fixed[:4], None):
        assert np.allclose(T._class_sums(node, bins, label, w, factor, known, 3, 8, 4), want)


def test_rows_find_their_nodes_by_number():
    rng = np.random.default_rng(13)
    bins = rng.integers(0, 50, (400, 3)).astype(np.uint8)
    top = T._top({1: (0, 20, 0.0), 2: (1, 10, 0.0), 3: (2, 25, 0.0), 6: (0, 40, 0.0), 13: (1, 5, 0.0)})
    far = T._place(top, bins[:20])  # too few rows to make the table for
    near = T._place(top, bins)
    assert (near[:20] == far).all() and len(set(near.tolist())) >= 5


def test_large_nodes_are_grown_by_class(spark, monkeypatch):
    rows, found = frame(spark), []
    for most in (10**6, 100):
        monkeypatch.setattr(T, "BLOCK_ROWS", most)
        found.append(FO.ForestClassifier(numTrees=4, maxDepth=5, minInstancesPerNode=3).fit(rows))
    assert np.allclose(found[0].state[3], found[1].state[3], atol=0.01)
    one, two = ([r.prediction for r in f.transform(rows).orderBy("a", "b", "c").collect()] for f in found)
    assert np.mean(np.array(one) == np.array(two)) > 0.98
