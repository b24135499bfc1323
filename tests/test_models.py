"""Learning jobs: properties that hold whatever the fit."""

import random

import pytest
from pyspark.sql import functions as F

from wakeline.plans import models as ML
from wakeline.operators import forecast as FC
from wakeline.operators import metrics as M

STEPS = 24


@pytest.fixture(scope="module")
def routes(spark):
    """Forty vessels on two clearly different routes: features, signature, labels."""

    rng = random.Random(4)
    feats, sig, labels = [], [], []
    for m in range(40):
        north = m % 2
        base = (54.0, 8.0) if north else (40.0, -5.0)
        feats.append((m, base[0] + rng.choice([0.0, 0.1]), base[1] + rng.choice([0.0, 0.1]), float(rng.randrange(3))))
        sig += [(m, k, base[0] + 0.05 * k + rng.gauss(0, 0.01), base[1] - 0.1 * k * (1 if north else -1) + rng.gauss(0, 0.01)) for k in range(STEPS)]
        labels.append((m, "north" if north else "south"))
    return (spark.createDataFrame(feats, "mmsi long, early_start_lat double, early_start_lon double, noise double"),
            spark.createDataFrame(sig, "mmsi long, step int, lat double, lon double"), spark.createDataFrame(labels, "mmsi long, route_label string"))


def test_strict_holdout_with_labels_and_with_a_fitted_catalog(spark, routes):
    feats, sig, labels = routes
    given = ML.strict_holdout(feats, sig, labels, num_trees=10, max_depth=4).first()
    assert (given.available, given.label_source, given.train_rows, given.test_rows) == (True, "existing_column", 32, 8)
    assert given.accuracy == 1.0 and given.route_classes_train == 2
    fitted = ML.strict_holdout(feats, sig, None, requested_clusters=2, num_trees=10, max_depth=4).first()
    assert (fitted.label_source, fitted.train_rows, fitted.test_rows) == ("train_fold_kmeans_signature", 32, 8)
    assert fitted.accuracy == 1.0 and fitted.route_classes_test <= fitted.route_classes_train == 2
    assert ML.strict_holdout(feats.limit(9), sig, labels).first().available is False


@pytest.mark.parametrize("job", ["split", "temporal", "strict"])
def test_route_jobs_read_the_labels_once(spark, routes, job):
    feats, sig, labels = routes
    read = spark.sparkContext.accumulator(0)

    def seen(name):
        read.add(1)
        return name

    counted = labels.select("mmsi", F.udf(seen, "string")("route_label").alias("route_label"))
    if job == "split":
        fit = lambda f, y: ML.route_classifier(f, y, num_trees=3, max_depth=3)
        assert ML.evaluate_split(fit, feats, counted).first().accuracy == 1.0
    elif job == "temporal":
        first = feats.selectExpr("mmsi", "timestamp_seconds(mmsi) AS first_timestamp")
        assert ML.temporal_holdout(feats, counted, first, num_trees=3).first().accuracy == 1.0
    else:
        assert ML.strict_holdout(feats, sig, counted, num_trees=3, max_depth=3).first().accuracy == 1.0
    assert read.value <= 40 * (2 if job == "strict" else 1)  # once for each side's labels


def test_saved_model_predicts_the_same(spark, routes, tmp_path):
    feats, _, labels = routes
    model = ML.route_classifier(feats, labels, num_trees=5, max_depth=3)
    ML.save_model(model, str(tmp_path / "m"), {"labels": labels})
    back, side = ML.load_model(spark, str(tmp_path / "m"), ["labels"])
    assert sorted(ML.predict_route(back, feats).collect()) == sorted(ML.predict_route(model, feats).collect())
    assert side["labels"].count() == 40


def test_route_probabilities(spark, routes):
    feats, _, labels = routes
    out = ML.predict_route(ML.route_classifier(feats, labels, num_trees=5, max_depth=3), feats).collect()
    assert len(out) == 40 and all(0.5 <= r.predicted_route_probability <= 1.0 for r in out)


def type_rows(spark, n=300):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        kind = "cargo" if i % 3 else "tug"
        rows.append((float(i), i // 10, rng.choice(["moored", "sailing", None]), rng.uniform(0, 20), rng.uniform(0, 360), rng.uniform(0, 360),
                     (30.0 if kind == "cargo" else 9.0) + rng.gauss(0, 2), None if i % 7 == 0 else 100.0, 5.0, kind))
    return spark.createDataFrame(rows, "rid double, mmsi long, navigationalstatus string, sog double, cog double, heading double, width double,"
                                       " length double, draught double, shiptype string")


def test_type_models(spark):
    rows = type_rows(spark)
    train, med = ML.prepare_type_rows(rows.where("mmsi < 20"))
    test, _ = ML.prepare_type_rows(rows.where("mmsi >= 20"), med)
    boosted = ML.boosted_types(ML.type_boost(train, rounds=12, max_depth=3), test)
    voted = ML.knn_vote(train, test)
    got = {r.rid: r for r in boosted.collect()}
    assert len(got) == 100 and all(abs(sum(r.prob) - 1) < 1e-9 for r in got.values())
    assert M.summary_metrics(boosted.selectExpr("shiptype AS label", "predicted_shiptype AS prediction")).first().accuracy > 0.95
    assert voted.count() == 100 and all(0 < r.probability <= 1 for r in voted.collect())


def test_blend_is_not_worse_than_either_member(spark):
    rng = random.Random(2)
    rows = [(i, 54.0 + rng.random(), 8.0, *[v for _ in (1, 2, 3) for v in (54.5 + rng.gauss(0, 0.1), 8.0, 54.4 + rng.gauss(0, 0.3), 8.1, 54.6, 8.05)]) for i in range(60)]
    cols = ", ".join(f"rf_lat_{h}h double, rf_lon_{h}h double, dr_lat_{h}h double, dr_lon_{h}h double, target_lat_{h}h double, target_lon_{h}h double" for h in (1, 2, 3))
    df = spark.createDataFrame(rows, f"rid long, lat double, lon double, {cols}")
    blend = {r.horizon_h: r.error_km for r in FC.blend_weights(df, (1, 2, 3), "rf_").collect()}
    for prefix in ("rf_", "dr_"):
        for r in M.horizon_error(df, (1, 2, 3), prefix).collect():
            assert blend[r.horizon_h] <= r.mean_error_km + 1e-9
