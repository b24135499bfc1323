"""Learning jobs on Spark ML: route clustering and classification, ship-type
classifiers with calibration, and the position forest.

Features are assembled with ``VectorAssembler`` from DataFrame columns;
imputation and scaling follow the reference (exact median, population std
with zero → 1) as DataFrame expressions, so nothing is collected to the
driver except fitted model parameters (bounded by the feature count).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.numeric import ROUND_OFFSET
from wakeline.operators.clean import column_medians
from wakeline.operators.knn import nearest_rows, weighted_vote
from wakeline.operators.track import wide_signature
from wakeline.plans.boosting import fit_boosted
from wakeline.plans.calibration import Calibration
from wakeline.plans.forests import ForestClassifier
from wakeline.plans.trees import fit_forest
from wakeline.scratch import Scratch

SEED = 42
MAX_DEPTH = 12  # of the forests' trees; the reference's grow without limit, Spark allows 30
# Fixed values of the reference.
EARLY_BASE = (
    "early_point_count", "early_duration_hours", "early_start_lat", "early_start_lon", "early_observed_lat",
    "early_observed_lon", "early_mean_lat", "early_mean_lon", "early_std_lat", "early_std_lon", "early_min_lat",
    "early_max_lat", "early_min_lon", "early_max_lon", "early_mean_sog", "early_std_sog", "early_max_sog",
    "early_slow_point_ratio", "early_mean_cog_sin", "early_mean_cog_cos", "width", "length", "draught", "shiptype",
    "early_total_distance_km", "early_displacement_km", "early_straightness_ratio", "early_bearing_sin",
    "early_bearing_cos",
)
FORECAST_FEATURES = ("lat", "lon", "sog", "cog", "cog_sin", "cog_cos", "width", "length", "draught", "delta_lat",
                     "delta_lon", "delta_hours")
NEIGHBOURS = 7
TYPE_NUMERIC = ("sog", "cog", "heading", "width", "length", "draught", "cog_sin", "cog_cos", "heading_sin",
                "heading_cos")


# ------------------------------------------------------------ helpers --

def balanced_weights(rows: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """class_weight='balanced': w = n / (k * n_class). The class table has
    one row per class: broadcast."""

    counts = rows.groupBy(label).agg(F.expr("count(1) AS _nc"))
    tot = counts.agg(F.expr("sum(_nc) AS _n"), F.expr("count(1) AS _k"))
    w = counts.crossJoin(tot).selectExpr(label, f"_n / (_k * _nc) AS {out}")
    return rows.join(F.broadcast(w), label)


def impute_median(rows: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Exact column medians (from value counts) as a one-row table, and the
    rows with nulls filled from it."""

    med = column_medians(rows, list(cols))
    filled = rows.crossJoin(F.broadcast(med.select(*[F.col(c).alias(f"_m_{c}") for c in cols]))).selectExpr(
        *[c for c in rows.columns if c not in cols],
        *[f"coalesce(CAST({c} AS DOUBLE), _m_{c}, 0.0D) AS {c}" for c in cols],
    )
    return filled, med


def standardise(rows: DataFrame, cols: Sequence[str], stats: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """z-score with population std, zero std → 1 (the reference's scaler;
    Spark's StandardScaler uses the sample std and maps constants to 0)."""

    if stats is None:
        stats = rows.agg(*[F.expr(f"avg({c}) AS _mu_{c}") for c in cols],
                         *[F.expr(f"CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0D"
                                  f" ELSE stddev_pop({c}) END AS _sd_{c}") for c in cols])
    out = rows.crossJoin(F.broadcast(stats)).selectExpr(
        *[c for c in rows.columns if c not in cols], *[f"({c} - _mu_{c}) / _sd_{c} AS {c}" for c in cols]
    )
    return out, stats


def macro_f1(scored: DataFrame, label: str = "label", pred: str = "prediction") -> float:
    from wakeline.operators.metrics import summary_metrics

    r = summary_metrics(scored, label, pred).first()
    return float(r["macro_f1"]) if r and r["macro_f1"] is not None else 0.0


# ------------------------------------------------------- route models --

def early_feature_matrix(early: DataFrame, static: DataFrame, early_sig_long: DataFrame, points: int = 24) -> DataFrame:
    """25 early features + 4 static + 2·P early signature columns per vessel."""

    sig = wide_signature(early_sig_long, "early", points)
    j = early.join(static.select("mmsi", "width", "length", "draught", "shiptype"), "mmsi").join(sig, "mmsi")
    return j.select("mmsi", *EARLY_BASE, *[c for c in sig.columns if c != "mmsi"])


def route_kmeans(scaled_wide: DataFrame, k: int, restarts: int = 5, max_iter: int = 500) -> tuple[DataFrame, DataFrame]:
    """KMeans (k-means||) on the scaled full signature, best of ``restarts``
    seeds by training cost; clusters renumbered by their centre's first
    coordinates so labels are stable: ``route_00`` …"""

    feats = [c for c in scaled_wide.columns if c != "mmsi"]
    va = VectorAssembler(inputCols=feats, outputCol="features")
    data = va.transform(scaled_wide).select("mmsi", "features").cache()
    best = None
    for s in range(max(1, restarts)):
        m = KMeans(k=k, maxIter=max_iter, seed=SEED + s, initMode="k-means||").fit(data)
        if best is None or m.summary.trainingCost < best.summary.trainingCost:
            best = m
    centres = best.clusterCenters()
    order = sorted(range(len(centres)), key=lambda i: (float(centres[i][0]), float(centres[i][1]), i))
    remap = {old: new for new, old in enumerate(order)}
    spark = scaled_wide.sparkSession
    rm = spark.createDataFrame([(int(o), int(n)) for o, n in remap.items()], "prediction int, cluster int")
    labels = best.transform(data).join(F.broadcast(rm), "prediction").selectExpr(
        "mmsi", "format_string('route_%02d', cluster) AS route_label"
    )
    data.unpersist()
    return labels, rm


def route_classifier(features: DataFrame, labels: DataFrame, num_trees: int = 500, seed: int = SEED,
                     max_depth: int = MAX_DEPTH) -> PipelineModel:
    """Balanced random forest (leaf ≥ 2) on the early feature matrix; trees
    grow to ``max_depth``."""

    rows = balanced_weights(features.join(labels, "mmsi"), "route_label")
    feats = [c for c in features.columns if c != "mmsi"]
    pipe = Pipeline(stages=[
        StringIndexer(inputCol="route_label", outputCol="label", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep"),
        ForestClassifier(numTrees=num_trees, minInstancesPerNode=2, seed=seed, maxDepth=max_depth),
    ])
    return pipe.fit(rows)


def predict_route(model: PipelineModel, features: DataFrame) -> DataFrame:
    """(mmsi, predicted_route, predicted_route_probability)."""

    labels = model.stages[0].labels
    spark = features.sparkSession
    lab = spark.createDataFrame([(float(i), l) for i, l in enumerate(labels)], "prediction double, predicted_route string")
    out = model.transform(features)
    return out.join(F.broadcast(lab), "prediction").select(
        "mmsi", "predicted_route", F.array_max(vector_to_array("probability")).alias("predicted_route_probability")
    )


def evaluate_split(model_fit, features: DataFrame, labels: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Fit on a vessel-group split and score the held-out vessels: one row
    of accuracy / macro F1 / weighted F1. What the fit and the scores read again
    and again (labelled features, sides, predictions) is written once."""

    from wakeline.operators.metrics import summary_metrics
    from wakeline.operators.splits import group_split

    scratch = Scratch(features.sparkSession, "evaluate")
    sp = scratch.write(group_split(scratch.write(features.join(labels, "mmsi"), "labelled"), "mmsi", test_size), "split")
    train, test = sp.where("NOT is_test").drop("is_test"), sp.where("is_test").drop("is_test")
    model = model_fit(train.drop("route_label"), train.select("mmsi", "route_label"))
    pred = predict_route(model, test.drop("route_label")).join(test.select("mmsi", "route_label"), "mmsi")
    pred = scratch.write(pred.select("route_label", "predicted_route"), "predicted")
    return summary_metrics(pred, "route_label", "predicted_route")


def temporal_holdout(features: DataFrame, labels: DataFrame, first_ts: DataFrame, frac: float = 0.8,
                     num_trees: int = 500) -> DataFrame:
    """Earliest ``frac`` of vessels (by first timestamp) train, the rest test.
    Both sides and the predictions are written once."""

    from wakeline.operators.metrics import summary_metrics
    from wakeline.operators.splits import smallest_k

    f = min(max(float(frac), 0.5), 0.9)
    v = first_ts.selectExpr("mmsi", "CAST(unix_seconds(first_timestamp) AS BIGINT) AS _t")
    n = v.count()
    k = int(round(f * n))
    base = v.agg(F.expr("min(_t) AS _t0")).first()["_t0"] or 0
    train_ids = smallest_k(v.selectExpr("mmsi", f"_t - {int(base)} AS _t"), k, "_t", "mmsi").select("mmsi")
    scratch = Scratch(features.sparkSession, "temporal")
    train_ids = scratch.write(train_ids, "train-ids")
    j = scratch.write(features.join(labels, "mmsi"), "labelled")
    train = scratch.write(j.join(train_ids, "mmsi", "left_semi"), "train")
    test = scratch.write(j.join(train_ids, "mmsi", "left_anti"), "test")
    model = route_classifier(train.drop("route_label"), train.select("mmsi", "route_label"), num_trees)
    pred = predict_route(model, test.drop("route_label")).join(test.select("mmsi", "route_label"), "mmsi")
    pred = scratch.write(pred.select("route_label", "predicted_route"), "predicted")
    return summary_metrics(pred, "route_label", "predicted_route")


def strict_holdout(features: DataFrame, scaled_long: DataFrame, labels: DataFrame | None, test_size: float = 0.2, requested_clusters: int = 0,
                   **forest) -> DataFrame:
    """Route classifier scored on held-out vessels with nothing learned from
    them: without ``labels`` (mmsi, route_label) the route catalog itself is
    fitted on the training vessels' signatures (k-means), and the held-out
    vessels get the nearest training route. One row: available, label_source,
    train_rows, test_rows, route_classes_train, route_classes_test, accuracy,
    macro_f1, weighted_f1; fewer than ten vessels are not available.
    """

    from wakeline.operators.cluster import assign_route, choose_cluster_count, label_centroids, scale_signature
    from wakeline.operators.metrics import summary_metrics
    from wakeline.operators.splits import group_split

    spark = features.sparkSession
    out = ("available boolean, label_source string, train_rows long, test_rows long, route_classes_train long, route_classes_test long,"
           " accuracy double, macro_f1 double, weighted_f1 double")
    if features.count() < 10:
        return spark.createDataFrame([(False, None, None, None, None, None, None, None, None)], out)
    split = group_split(features, "mmsi", min(max(float(test_size), 0.05), 0.5))
    scratch = Scratch(spark, "holdout")
    split = scratch.write(split, "split")
    train, test = (split.where(side).drop("is_test") for side in ("NOT is_test", "is_test"))
    if labels is not None:
        source = "existing_column"
        known = labels.selectExpr("mmsi", "coalesce(CAST(route_label AS STRING), 'unknown_route') AS route_label")
        y_train, y_test = (known.join(side.select("mmsi"), "mmsi", "left_semi") for side in (train, test))
    else:
        source = "train_fold_kmeans_signature"
        own = scaled_long.join(train.select("mmsi"), "mmsi", "left_semi")
        scaled, scaler = (scratch.write(t, name) for t, name in zip(scale_signature(own), ("scaled", "scaler"), strict=True))
        wide = wide_signature(scaled, "route")
        y_train, _ = route_kmeans(wide, choose_cluster_count(wide.count(), requested_clusters))
        y_train = scratch.write(y_train, "labels")  # read by the centroids, the classifier and the counts
        rest = scaled_long.join(test.select("mmsi"), "mmsi", "left_semi").join(F.broadcast(scaler), "step").selectExpr(
            "mmsi", "step", "(lat - mean_lat) / scale_lat AS lat", "(lon - mean_lon) / scale_lon AS lon")
        y_test = assign_route(rest, label_centroids(scaled, y_train)).select("mmsi", "route_label")
    if labels is not None:
        y_train = scratch.write(y_train, "labels")
    y_test = scratch.write(y_test, "test-labels")
    model = route_classifier(train, y_train, **forest)
    pred = scratch.write(predict_route(model, test).join(y_test, "mmsi").select("route_label", "predicted_route"), "predicted")
    counts = [y.agg(F.count("*").alias(f"{side}_rows"), F.count_distinct("route_label").alias(f"route_classes_{side}")) for y, side in ((y_train, "train"), (y_test, "test"))]
    scores = summary_metrics(pred, "route_label", "predicted_route")
    return scores.crossJoin(counts[0]).crossJoin(counts[1]).selectExpr(
        "true AS available", f"'{source}' AS label_source", "train_rows", "test_rows", "route_classes_train", "route_classes_test",
        "accuracy", "macro_f1", "weighted_f1")


# --------------------------------------------------------- ship types --

def type_pipeline(kind: str, num_trees: int = 200, lr_iter: int = 2000, max_depth: int = MAX_DEPTH) -> Pipeline:
    """Preprocess + classifier. Numeric features are already imputed (exact
    medians) and, for logistic regression, standardised by the caller;
    categories are indexed (unknown kept) and one-hot encoded."""

    idx = StringIndexer(inputCol="navigationalstatus", outputCol="_nav_idx", handleInvalid="keep",
                        stringOrderType="alphabetAsc")
    ohe = OneHotEncoder(inputCols=["_nav_idx"], outputCols=["_nav_vec"], handleInvalid="keep")
    lab = StringIndexer(inputCol="shiptype", outputCol="label", handleInvalid="skip", stringOrderType="alphabetAsc")
    va = VectorAssembler(inputCols=[*TYPE_NUMERIC, "_nav_vec"], outputCol="features", handleInvalid="keep")
    if kind == "logistic_regression":
        clf = LogisticRegression(maxIter=lr_iter, family="multinomial", weightCol="weight")
    elif kind == "random_forest":
        clf = ForestClassifier(numTrees=num_trees, seed=SEED, maxDepth=max_depth)
    else:
        raise ValueError(f"unknown model {kind!r}")
    return Pipeline(stages=[idx, ohe, lab, va, clf])


def prepare_type_rows(rows: DataFrame, medians: DataFrame | None = None, weighted: bool = True) -> tuple[DataFrame, DataFrame]:
    """Encoded and imputed rows, and the medians used: the rows' own, or those
    of the training rows when given. ``weighted`` adds balanced class weights
    (training and evaluation rows, which have a label)."""

    from wakeline.operators.shiptype import trig_encode

    r = trig_encode(rows)
    if medians is None:
        r, medians = impute_median(r, TYPE_NUMERIC)
    else:
        r = r.crossJoin(F.broadcast(medians.select(*[F.col(c).alias(f"_m_{c}") for c in TYPE_NUMERIC]))).selectExpr(
            *[c for c in r.columns if c not in TYPE_NUMERIC],
            *[f"coalesce(CAST({c} AS DOUBLE), _m_{c}, 0.0D) AS {c}" for c in TYPE_NUMERIC],
        )
    return (balanced_weights(r, "shiptype") if weighted else r), medians


def boost_columns(train: DataFrame) -> list[str]:
    """The navigational statuses of the training rows, in order: one 0/1 feature each."""

    found = train.select("navigationalstatus").where("navigationalstatus IS NOT NULL").distinct().orderBy("navigationalstatus")
    return [r[0] for r in found.collect()]


def boost_features(rows: DataFrame, status: Sequence[str]) -> tuple[DataFrame, list[str]]:
    flags = [F.coalesce((F.col("navigationalstatus") == s).cast("double"), F.lit(0.0)).alias(f"_st{i}") for i, s in enumerate(status)]
    return rows.select("*", *flags), [*TYPE_NUMERIC, *(f"_st{i}" for i in range(len(status)))]


def type_boost(train: DataFrame, rounds: int = 300, max_depth: int = 8) -> dict:
    """Gradient boosting over prepared training rows: rate 0.1, four of five
    rows for each tree."""

    status = boost_columns(train)
    ready, names = boost_features(train, status)
    return {"model": fit_boosted(ready, names, "shiptype", rounds, max_depth, seed=SEED), "status": status}


def boosted_types(bundle: dict, rows: DataFrame) -> DataFrame:
    """Prepared rows with ``prob``, ``prediction`` and ``predicted_shiptype``."""

    ready, names = boost_features(rows, bundle["status"])
    scored = bundle["model"].predict(ready, names, "prob").drop(*[c for c in names if c.startswith("_st")])
    classes = F.array(*[F.lit(c) for c in bundle["model"].classes])
    best = F.array_position("prob", F.array_max("prob"))
    return scored.withColumn("prediction", (best - 1).cast("double")).withColumn("predicted_shiptype", F.element_at(classes, best.cast("int")))


def fit_type_model(train: DataFrame, kind: str, **kw) -> PipelineModel:
    return type_pipeline(kind, **kw).fit(train)


def type_probabilities(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(row id columns…, label, prediction, probability array) with the
    predicted class index mapped back to its name."""

    labels = model.stages[2].labels
    spark = rows.sparkSession
    names = spark.createDataFrame([(float(i), l) for i, l in enumerate(labels)], "prediction double, predicted_shiptype string")
    out = model.transform(rows)
    prob = vector_to_array("probability") if "probability" in out.columns else F.array()
    return out.withColumn("prob", prob).join(F.broadcast(names), "prediction")


def predict_type(model: PipelineModel, calibration: Calibration, medians: DataFrame, rows: DataFrame, key: str = "mmsi") -> DataFrame:
    """(key, predicted_shiptype, confidence) of new rows. Columns that the rows
    lack are added as nulls and filled from the training medians; confidence is
    the calibrated probability of the most likely class."""

    for c in (*TYPE_NUMERIC, "navigationalstatus"):
        if c not in rows.columns and not c.endswith(("_sin", "_cos")):
            rows = rows.withColumn(c, F.lit(None).cast("string" if c == "navigationalstatus" else "double"))
    ready, _ = prepare_type_rows(rows, medians, weighted=False)
    unlabelled = PipelineModel(stages=[m for i, m in enumerate(model.stages) if i != 2])  # all but the label's index
    scored = unlabelled.transform(ready).withColumn("prob", vector_to_array("probability")).drop("rawPrediction", "probability")
    best = calibration.apply(scored.drop("features")).selectExpr(
        key, "array_max(calibrated_prob) AS confidence",
        "CAST(array_position(calibrated_prob, array_max(calibrated_prob)) - 1 AS DOUBLE) AS prediction")
    names = rows.sparkSession.createDataFrame(
        [(float(i), n) for i, n in enumerate(model.stages[2].labels)], "prediction double, predicted_shiptype string")
    return best.join(F.broadcast(names), "prediction").select(key, "predicted_shiptype", "confidence")


def neighbour_vectors(train: DataFrame, rows: DataFrame, key: str = "rid") -> tuple[DataFrame, DataFrame]:
    """(key, label, x) of prepared training rows and (key, x) of other prepared
    rows: numbers standardised by the training rows, then one place per
    navigational status of theirs. Values are whole millionths, so that equal
    rows stay equal in whatever order the means were summed up. A missing status
    counts as the most frequent one; one that training lacks has no place."""

    status = train.groupBy("navigationalstatus").count().where("navigationalstatus IS NOT NULL")
    names = [r[0] for r in status.orderBy(F.desc("count"), "navigationalstatus").select("navigationalstatus").collect()]
    usual = F.lit(names[0] if names else None)
    filled = F.coalesce("navigationalstatus", usual)
    places = [F.coalesce(F.when(filled == n, 1e6), F.lit(0.0)) for n in sorted(names)]
    known, stats = standardise(train, TYPE_NUMERIC)
    other, _ = standardise(rows, TYPE_NUMERIC, stats)
    x = F.array(*[F.expr(f"CAST(floor({c} * 1000000.0D + {ROUND_OFFSET}D) AS DOUBLE)") for c in TYPE_NUMERIC], *places).alias("x")
    return known.select(key, F.col("shiptype").alias("label"), x), other.select(key, x)


def knn_vote(train: DataFrame, rows: DataFrame, key: str = "rid", k: int = NEIGHBOURS) -> DataFrame:
    """(key, predicted_shiptype, probability) by the distance-weighted vote of
    the ``k`` nearest training rows."""

    known, asked = neighbour_vectors(train, rows, key)
    near = nearest_rows(known, asked, k, key, key)
    return weighted_vote(near).selectExpr(f"query AS {key}", "prediction AS predicted_shiptype", "probability")


def vote_probabilities(scored: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Soft vote: mean of the members' class-probability arrays (same class
    order), prediction = argmax."""

    base = None
    for i, s in enumerate(scored):
        x = s.select(*key, F.col("prob").alias(f"_p{i}"))
        base = x if base is None else base.join(x, list(key))
    n = len(scored)
    expr = f"transform(_p0, (v, i) -> ({' + '.join(f'_p{j}[i]' for j in range(n))}) / {float(n)}D)"
    return base.selectExpr(*key, f"{expr} AS prob").selectExpr(
        *key, "prob", "CAST(array_position(prob, array_max(prob)) - 1 AS DOUBLE) AS prediction"
    )


def class_confidence(scored: DataFrame) -> DataFrame:
    """Probability of the predicted class."""

    return scored.selectExpr("*", "element_at(prob, CAST(prediction AS INT) + 1) AS confidence")


def feature_importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Named feature importances of the fitted forest (slot names from the
    assembler's metadata), sorted descending."""

    va_out = model.transform(rows.limit(1))
    meta = va_out.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted([a for group in meta.values() for a in group], key=lambda a: a["idx"])
    imp = model.stages[-1].featureImportances.toArray()
    spark = rows.sparkSession
    data = [(s["name"], float(imp[s["idx"]])) for s in slots if s["idx"] < len(imp)]
    return spark.createDataFrame(data, "feature string, importance double").orderBy(F.desc("importance"))


# --------------------------------------------------- position forest --

def position_forest(train: DataFrame, horizons: Sequence[int], num_trees: int = 80, max_depth: int = 18,
                    min_leaf: int = 5) -> dict:
    """One forest for the latitude and longitude of all horizons; features
    filled with their medians."""

    filled, med = impute_median(train, FORECAST_FEATURES)
    targets = [f"target_{a}_{h}h" for h in horizons for a in ("lat", "lon")]
    return {"forest": fit_forest(filled, FORECAST_FEATURES, targets, num_trees, max_depth, min_leaf, SEED), "medians": med}


def predict_positions(bundle: dict, rows: DataFrame, prefix: str = "rf_") -> DataFrame:
    """``rows`` with ``<prefix>lat_<h>h`` and ``<prefix>lon_<h>h`` of every horizon."""

    med, forest = bundle["medians"], bundle["forest"]
    filled = rows.crossJoin(F.broadcast(med.select(*[F.col(c).alias(f"_m_{c}") for c in FORECAST_FEATURES]))).selectExpr(
        *[c for c in rows.columns],
        *[f"coalesce(CAST({c} AS DOUBLE), _m_{c}, 0.0D) AS _f_{c}" for c in FORECAST_FEATURES],
    )
    out = forest.predict(filled, [f"_f_{c}" for c in FORECAST_FEATURES], [prefix + t.removeprefix("target_") for t in forest.targets])
    return out.drop(*[f"_f_{c}" for c in FORECAST_FEATURES])


def random_search(train: DataFrame, n_iter: int = 12, cv_folds: int = 3, seed: int = SEED) -> DataFrame:
    """Sampled forest settings scored by macro F1 over stratified
    vessel-group folds (``group_folds``); one row per setting."""

    import random

    from wakeline.operators.splits import group_folds

    folds = group_folds(train, "mmsi", "shiptype", cv_folds).cache()
    rng = random.Random(seed)
    rows = []
    for i in range(n_iter):
        trees = rng.choice([50, 100, 200])
        depth = rng.choice([5, 10, 15, 20])
        scores = []
        for k in range(cv_folds):
            tr, te = folds.where(f"fold <> {k}").drop("fold"), folds.where(f"fold = {k}").drop("fold")
            pipe = type_pipeline("random_forest", num_trees=trees)
            pipe.getStages()[-1].setMaxDepth(depth)
            m = pipe.fit(tr)
            s = type_probabilities(m, te).selectExpr("shiptype AS label", "predicted_shiptype AS prediction")
            scores.append(macro_f1(s))
        rows.append((i, trees, depth, float(sum(scores) / len(scores))))
    folds.unpersist()
    return train.sparkSession.createDataFrame(rows, "setting int, num_trees int, max_depth int, cv_macro_f1 double")


def save_model(model: PipelineModel, path: str, side_tables: dict[str, DataFrame] | None = None) -> None:
    """Pipeline plus side tables (medians, thresholds, centroids) as parquet."""

    model.write().overwrite().save(f"{path}/pipeline")
    for name, df in (side_tables or {}).items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load_model(spark, path: str, names: Sequence[str] = ()) -> tuple[PipelineModel, dict[str, DataFrame]]:
    return PipelineModel.load(f"{path}/pipeline"), {n: spark.read.parquet(f"{path}/{n}") for n in names}
