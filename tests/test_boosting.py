"""Boosted trees: falling loss, the same trees by level or in one task."""

import numpy as np
from pyspark.sql import functions as F

from wakeline.plans import boosting as B


def frame(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 10, (n, 2)), 1)
    label = np.where(x[:, 0] > 6, "a", np.where(x[:, 1] > x[:, 0], "b", "c"))
    rows = [(float(a), float(b), str(c), "k") for (a, b), c in zip(x, label, strict=True)]
    return spark.createDataFrame([*rows, (1.0, 1.0, None, "k")], "a double, b double, kind string, u string").repartition(2)


def score(model, rows):
    got = model.predict(rows.where("kind IS NOT NULL"), ["a", "b"]).collect()
    assert all(abs(sum(r.prob) - 1) < 1e-12 for r in got)
    p = np.array([r.prob[model.classes.index(r.kind)] for r in got])
    right = np.mean([model.classes[int(np.argmax(r.prob))] == r.kind for r in got])
    return -np.log(p).mean(), right


def test_loss_falls_and_classes_are_found(spark, monkeypatch):
    monkeypatch.setattr(B, "SAVE", 4)
    rows = frame(spark)
    losses = [score(B.fit_boosted(rows, ["a", "b"], "kind", rounds=r, max_depth=4), rows) for r in (0, 3, 14)]
    assert losses[0][0] > losses[1][0] > losses[2][0] and losses[2][1] > 0.95


def test_levels_give_the_trees_of_one_task(spark):
    rows = frame(spark)
    one, many = (B.fit_boosted(rows, ["a", "b"], "kind", rounds=2, max_depth=3, local_rows=k) for k in (10_000, 60))
    for a, b in zip(one.trees, many.trees, strict=True):
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and np.allclose(a[3], b[3])


def test_one_class(spark):
    model = B.fit_boosted(frame(spark).where("kind = 'a'"), ["a", "b"], "kind", rounds=3)
    assert model.trees == [] and model.classes == ["a"]


def test_the_query_runs_all_rounds(spark, monkeypatch):
    # 300 rounds of depth 8, as in the reference; the query asked for 60
    from wakeline.plans import catalog as Q
    from wakeline.plans import models as ML

    rows = frame(spark, 30).withColumn("navigationalstatus", F.lit("moored"))
    asked = []
    monkeypatch.setattr(Q, "type_split", lambda *_: (rows, rows))
    monkeypatch.setattr(Q, "source_tag", lambda *_: "none")
    monkeypatch.setattr(Q, "fitted", lambda key, fit: fit())
    monkeypatch.setattr(ML, "boost_features", lambda r, status: (r, ["a", "b"]))
    monkeypatch.setattr(ML, "fit_boosted", lambda r, names, label, rounds, depth, **kw: asked.append((rounds, depth)))
    monkeypatch.setattr(ML, "boosted_types", lambda bundle, test: test.selectExpr("kind AS shiptype", "kind AS predicted_shiptype"))
    assert Q.q_type_boost(spark, "none").count() == 1 and asked == [(300, 8)]
