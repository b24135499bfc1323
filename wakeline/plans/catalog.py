"""The registered queries: (spark, sf_dir) -> DataFrame, one per operator.

Every query reads the driver's parquet tables (through the fixture builders in
``wakeline.sources.fixtures``) and runs on all of their rows. Floating results
are rounded with ``round_doubles`` so they compare across engines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.numeric import round_doubles
from wakeline.operators import clean as C
from wakeline.operators import forecast as FC
from wakeline.operators import metrics as M
from wakeline.operators import mapview as MV
from wakeline.operators import predictions as P
from wakeline.operators import splits as S
from wakeline.operators import shiptype as TY
from wakeline.sources import readers as R
from wakeline.operators import cluster as K
from wakeline.operators import joins as J
from wakeline.operators import track as T
from wakeline.operators import vessel as V
from wakeline.plans import models as ML
from wakeline.plans.calibration import fit_calibration
from wakeline.plans.stages import source_tag, stage_path, stage_table
from wakeline.scratch import Scratch
from wakeline.sources import fixtures as X
from wakeline.streaming import ais_stream as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned route-path points, staged once per input folder."""

    return stage_table(spark, "clean_points", sf_dir, lambda: C.clean_points(X.ais_points(spark, sf_dir)))


# ------------------------------------------------------------ cleaning --

@query("clean_points")
def q_clean_points(spark, sf_dir):
    """The full cleaner over the fixture (not the staged copy)."""

    return round_doubles(C.clean_points(X.ais_points(spark, sf_dir)))


# ----------------------------------------------------------- summaries --

@query("vessel_summary")
def q_vessel_summary(spark, sf_dir):
    return round_doubles(V.vessel_summary(clean(spark, sf_dir)))


@query("early_summary")
def q_early_summary(spark, sf_dir):
    return round_doubles(V.early_summary(clean(spark, sf_dir)))


@query("vessel_label_mode")
def q_vessel_label_mode(spark, sf_dir):
    return V.vessel_label_mode(clean(spark, sf_dir))


@query("hourly_resample")
def q_hourly_resample(spark, sf_dir):
    return round_doubles(V.hourly_resample(C.clean_points_hourly(X.ais_points(spark, sf_dir))))


@query("clean_points_hourly")
def q_clean_points_hourly(spark, sf_dir):
    return round_doubles(C.clean_points_hourly(X.ais_points(spark, sf_dir)))


@query("clean_points_forecast")
def q_clean_points_forecast(spark, sf_dir):
    return round_doubles(C.clean_points_forecast(X.ais_points(spark, sf_dir)))


# ------------------------------------------------------------ sequences --

@query("stop_events")
def q_stop_events(spark, sf_dir):
    return round_doubles(T.stop_event_points(clean(spark, sf_dir)).select("mmsi", "rid", "ts", "stop_event_no"))


@query("stop_event_summary")
def q_stop_event_summary(spark, sf_dir):
    return round_doubles(T.stop_events(clean(spark, sf_dir)))


@query("segment_distance")
def q_segment_distance(spark, sf_dir):
    return round_doubles(V.segment_distance(clean(spark, sf_dir)).select("mmsi", "rid", "ts", "segment_km"))


@query("motion_features")
def q_motion_features(spark, sf_dir):
    pts = C.clean_points_forecast(X.ais_points(spark, sf_dir))
    return round_doubles(
        T.motion_features(pts).select("mmsi", "rid", "cog_sin", "cog_cos", "delta_lat", "delta_lon", "delta_hours")
    )


@query("early_track")
def q_early_track(spark, sf_dir):
    return V.early_track(clean(spark, sf_dir)).select("mmsi", "rid", "ts")


@query("track_signature")
def q_track_signature(spark, sf_dir):
    return round_doubles(T.track_signature(clean(spark, sf_dir)))


@query("latest_position")
def q_latest_position(spark, sf_dir):
    return round_doubles(T.latest_position(clean(spark, sf_dir), cols=["ts", "lat", "lon", "sog", "cog"]))


@query("dedupe_track")
def q_dedupe_track(spark, sf_dir):
    pts = C.clean_points_forecast(X.ais_points(spark, sf_dir))
    return T.dedupe_track(pts).select("mmsi", "rid")


@query("downsample_track")
def q_downsample_track(spark, sf_dir):
    pts = clean(spark, sf_dir).select("mmsi", "ts", "lat", "lon")
    return round_doubles(T.downsample_track(pts, T.TRACK_POINTS).select("mmsi", "ts", "idx", "n", "keep_idx"))


@query("split_gaps")
def q_split_gaps(spark, sf_dir):
    line = T.track_line_points(clean(spark, sf_dir), T.TRACK_POINTS)
    return T.split_gaps(line.select("mmsi", "ts", "lat", "lon")).select("mmsi", "ts", "piece")


@query("latest_bearing")
def q_latest_bearing(spark, sf_dir):
    pts = clean(spark, sf_dir)
    return round_doubles(T.latest_bearing(pts, T.track_line_points(pts, T.TRACK_POINTS)))


# ----------------------------------------------------------------- joins --

def forecast_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast-path points with motion features, staged once per input."""

    return stage_table(
        spark, "forecast_points", sf_dir,
        lambda: T.motion_features(C.clean_points_forecast(X.ais_points(spark, sf_dir))),
    )


def supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supervised forecast rows (points with 1/2/3 h targets), staged."""

    return stage_table(spark, "supervised_rows", sf_dir, lambda: J.future_targets(forecast_points(spark, sf_dir)))


@query("future_targets")
def q_future_targets(spark, sf_dir):
    out = J.future_targets(forecast_points(spark, sf_dir))
    cols = ["mmsi", "rid"] + [f"target_{k}_{h}h" for h in J.HORIZONS_H for k in ("timestamp", "lat", "lon")]
    return round_doubles(out.select(*cols))


# ------------------------------------------------------ route / anchorage --

def vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(spark, "vessel_summary", sf_dir, lambda: V.vessel_summary(clean(spark, sf_dir)))


def signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(spark, "track_signature", sf_dir, lambda: T.track_signature(clean(spark, sf_dir)))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(spark, "stop_events", sf_dir, lambda: T.stop_events(clean(spark, sf_dir)))


def anchorage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(spark, "anchorage_events", sf_dir, lambda: K.anchorage_dbscan(stops(spark, sf_dir)))


def anchorages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(spark, "anchorages", sf_dir, lambda: K.anchorage_summary(anchorage_events(spark, sf_dir)))


def route_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing route labels per vessel (mode) with the mode's share of the
    vessel's labelled points; vessels without any label get unknown_route."""

    pts = clean(spark, sf_dir)
    mode = V.vessel_label_mode(pts)
    share = pts.where("route_label IS NOT NULL").groupBy("mmsi", "route_label").agg(F.expr("count(1) AS _n")).join(
        mode, ["mmsi", "route_label"]
    ).join(
        pts.where("route_label IS NOT NULL").groupBy("mmsi").agg(F.expr("count(1) AS _t")), "mmsi"
    ).selectExpr("mmsi", "_n / _t AS label_share")
    allv = pts.select("mmsi").distinct()
    return allv.join(mode, "mmsi", "left").join(share, "mmsi", "left").selectExpr(
        "mmsi", "coalesce(route_label, 'unknown_route') AS route_label", "coalesce(label_share, 0.0D) AS label_share"
    )


def known_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mmsi, route_label) of ``route_labels``, staged once per input."""

    return stage_table(spark, "route_labels", sf_dir, lambda: route_labels(spark, sf_dir)).select("mmsi", "route_label")


def route_space(spark: SparkSession, sf_dir: str):
    scaled, scaler = K.scale_signature(signature(spark, sf_dir))
    labels = route_labels(spark, sf_dir)
    cents = K.label_centroids(scaled, labels)
    return scaled, scaler, labels, cents


@query("anchorage_neighbors")
def q_anchorage_neighbors(spark, sf_dir):
    return K.neighbour_counts(stops(spark, sf_dir))


@query("anchorage_dbscan")
def q_anchorage_dbscan(spark, sf_dir):
    return anchorage_events(spark, sf_dir).select("mmsi", "stop_event_no", "anchorage_cluster", "anchorage_id")


@query("anchorage_summary")
def q_anchorage_summary(spark, sf_dir):
    return round_doubles(anchorages(spark, sf_dir))


@query("nearest_anchorage")
def q_nearest_anchorage(spark, sf_dir):
    out = J.nearest_centre(vessels(spark, sf_dir), anchorages(spark, sf_dir))
    return round_doubles(out.selectExpr(
        "mmsi", "anchorage_id AS predicted_anchorage_id", "centre_lat AS predicted_anchorage_lat",
        "centre_lon AS predicted_anchorage_lon", "distance_km AS anchorage_distance_km",
        f"1.0D / (1.0D + distance_km / {max(K.ANCHORAGE_EPS_KM, 0.1)}D) AS anchorage_confidence",
    ))


@query("scale_signature")
def q_scale_signature(spark, sf_dir):
    scaled, _ = K.scale_signature(signature(spark, sf_dir))
    return round_doubles(scaled)


@query("label_centroids")
def q_label_centroids(spark, sf_dir):
    return round_doubles(route_space(spark, sf_dir)[3])


@query("route_centers")
def q_route_centers(spark, sf_dir):
    _, scaler, _, cents = route_space(spark, sf_dir)
    return round_doubles(K.route_centers(cents, scaler))


@query("route_distance")
def q_route_distance(spark, sf_dir):
    scaled, _, labels, cents = route_space(spark, sf_dir)
    return round_doubles(K.route_distance(scaled, labels, cents))


@query("assign_route")
def q_assign_route(spark, sf_dir):
    """Every vessel's signature to the nearest of the fitted route centres."""

    scaled, _, _, cents = route_space(spark, sf_dir)
    return round_doubles(K.assign_route(scaled, cents))


@query("anomaly_thresholds")
def q_anomaly_thresholds(spark, sf_dir):
    scaled, _, labels, cents = route_space(spark, sf_dir)
    return round_doubles(K.anomaly_thresholds(K.route_distance(scaled, labels, cents)))


@query("route_catalog")
def q_route_catalog(spark, sf_dir):
    return round_doubles(K.route_catalog(vessels(spark, sf_dir), route_labels(spark, sf_dir)))


@query("attach_labels")
def q_attach_labels(spark, sf_dir):
    return vessels(spark, sf_dir).join(route_labels(spark, sf_dir), "mmsi").select("mmsi", "point_count", "route_label")


# ------------------------------------------------------------ predictions --

def type_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given ship-type predictions: each vessel's most frequent reported type
    and its share of the vessel's reports."""

    raw = X.ais_points(spark, sf_dir).where("shiptype IS NOT NULL")
    cnt = raw.groupBy("mmsi", "shiptype").agg(F.expr("count(1) AS _n"))
    return cnt.groupBy("mmsi").agg(
        F.expr("min_by(shiptype, struct(-_n, shiptype)) AS predicted_shiptype"),
        F.expr("max(_n) / sum(_n) AS predicted_shiptype_probability"),
    )


def nearest_anchorages(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = J.nearest_centre(vessels(spark, sf_dir), anchorages(spark, sf_dir))
    return near.selectExpr(
        "mmsi", "anchorage_id AS predicted_anchorage_id", "centre_lat AS predicted_anchorage_lat",
        "centre_lon AS predicted_anchorage_lon", "distance_km AS anchorage_distance_km",
        f"1.0D / (1.0D + distance_km / {max(K.ANCHORAGE_EPS_KM, 0.1)}D) AS anchorage_confidence",
    )


def assigned_routes(spark: SparkSession, sf_dir: str):
    scaled, scaler, labels, cents = route_space(spark, sf_dir)
    dist = K.route_distance(scaled, labels, cents)
    thr = K.anomaly_thresholds(dist)
    assigned = labels.selectExpr(
        "mmsi", "route_label AS predicted_route", "label_share AS predicted_route_probability"
    )
    return K.threshold_lookup(assigned, thr), dist


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-vessel route predictions from the given route labels (label mode,
    share as probability), anomaly scoring, nearest anchorage, ship type."""

    def build():
        assigned, dist = assigned_routes(spark, sf_dir)
        pred = P.score_routes(vessels(spark, sf_dir), assigned, dist)
        pred = P.attach_anchorage(pred, nearest_anchorages(spark, sf_dir))
        return pred.join(type_mode(spark, sf_dir), "mmsi", "left")

    return stage_table(spark, "predictions", sf_dir, build)


@query("threshold_lookup")
def q_threshold_lookup(spark, sf_dir):
    return round_doubles(assigned_routes(spark, sf_dir)[0].select("mmsi", "predicted_route", "route_distance_threshold"))


@query("anomaly_score")
def q_anomaly_score(spark, sf_dir):
    return round_doubles(predictions(spark, sf_dir).select("mmsi", "route_distance_ratio", "anomaly_score", "is_anomaly"))


@query("attach_anchorage")
def q_attach_anchorage(spark, sf_dir):
    return round_doubles(predictions(spark, sf_dir))


@query("rank_predictions")
def q_rank_predictions(spark, sf_dir):
    return round_doubles(P.rank_predictions(predictions(spark, sf_dir)).select("mmsi", "is_anomaly", "anomaly_score"))


@query("anomaly_ships")
def q_anomaly_ships(spark, sf_dir):
    return round_doubles(P.anomaly_ships(predictions(spark, sf_dir)).select("mmsi", "predicted_route", "anomaly_score"))


@query("top_ships")
def q_top_ships(spark, sf_dir):
    return round_doubles(P.top_ships(predictions(spark, sf_dir)).select(
        "mmsi", "is_anomaly", "predicted_route_probability"))


@query("filter_predictions")
def q_filter_predictions(spark, sf_dir):
    p = predictions(spark, sf_dir)
    a = P.filter_predictions(p, ship_type="Cargo", route_label="__all__").selectExpr("'type' AS filter", "mmsi")
    b = P.filter_predictions(p, route_label="lane_1").selectExpr("'route' AS filter", "mmsi")
    c = P.filter_predictions(p, anomaly_only=True).selectExpr("'anomaly' AS filter", "mmsi")
    return a.unionByName(b).unionByName(c)


@query("value_counts")
def q_value_counts(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return P.value_counts(p, "predicted_shiptype").selectExpr("'shipTypes' AS kind", "*").unionByName(
        P.value_counts(p, "predicted_route").selectExpr("'routes' AS kind", "*"))


@query("route_summary")
def q_route_summary(spark, sf_dir):
    return round_doubles(P.route_summary(predictions(spark, sf_dir)))


@query("type_route_counts")
def q_type_route_counts(spark, sf_dir):
    return P.type_route_counts(predictions(spark, sf_dir))


@query("route_anomaly_pivot")
def q_route_anomaly_pivot(spark, sf_dir):
    return P.route_anomaly_pivot(predictions(spark, sf_dir))


@query("route_type_crosstab")
def q_route_type_crosstab(spark, sf_dir):
    return P.route_type_crosstab(predictions(spark, sf_dir))


@query("bounds")
def q_bounds(spark, sf_dir):
    _, scaler, _, cents = route_space(spark, sf_dir)
    return round_doubles(P.bounds(predictions(spark, sf_dir), K.route_centers(cents, scaler)))


@query("anchorage_predictions")
def q_anchorage_predictions(spark, sf_dir):
    return round_doubles(P.anchorage_predictions(predictions(spark, sf_dir)))


def predictions_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as read back from a CSV: every value text."""

    p = predictions(spark, sf_dir)
    return p.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in p.columns])


PRED_NUMERIC = ("start_lat", "start_lon", "end_lat", "end_lon", "predicted_route_probability", "anomaly_score",
                "route_distance_ratio", "mean_sog", "width", "length", "draught")


@query("normalise_predictions")
def q_normalise_predictions(spark, sf_dir):
    t = predictions_text(spark, sf_dir).select("mmsi", "predicted_shiptype", "is_anomaly", *PRED_NUMERIC)
    return round_doubles(P.normalise_predictions(t, PRED_NUMERIC))


@query("parse_bool")
def q_parse_bool(spark, sf_dir):
    return predictions_text(spark, sf_dir).select("mmsi", C.parse_bool("is_anomaly").alias("is_anomaly"))


@query("clean_number_text")
def q_clean_number_text(spark, sf_dir):
    t = predictions_text(spark, sf_dir)
    return round_doubles(t.select("mmsi", *[C.clean_number_text(c).alias(c) for c in ("anomaly_score", "mean_sog")]))


@query("valid_lonlat")
def q_valid_lonlat(spark, sf_dir):
    from wakeline.functions.geo import valid_lonlat

    return X.ais_points(spark, sf_dir).select("rid", valid_lonlat("lon", "lat").alias("valid"))


# ---------------------------------------------------------------- metrics --

def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_table(spark, "label_predictions", sf_dir, lambda: X.label_predictions(spark, sf_dir))


@query("class_counts")
def q_class_counts(spark, sf_dir):
    return M.class_counts(labelled(spark, sf_dir))


@query("class_metrics")
def q_class_metrics(spark, sf_dir):
    return round_doubles(M.class_metrics(labelled(spark, sf_dir)))


@query("summary_metrics")
def q_summary_metrics(spark, sf_dir):
    return round_doubles(M.summary_metrics(labelled(spark, sf_dir)))


@query("sorted_class_metrics")
def q_sorted_class_metrics(spark, sf_dir):
    return round_doubles(M.class_metrics(labelled(spark, sf_dir)).orderBy(F.desc("support"), F.desc("f1_score")))


@query("confusion_pairs")
def q_confusion_pairs(spark, sf_dir):
    return round_doubles(M.confusion_pairs(labelled(spark, sf_dir)))


@query("top_confusions")
def q_top_confusions(spark, sf_dir):
    return round_doubles(M.top_confusions(labelled(spark, sf_dir), 10))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return round_doubles(M.confusion_matrix(labelled(spark, sf_dir)))


@query("calibration_error")
def q_calibration_error(spark, sf_dir):
    return round_doubles(M.calibration_error(labelled(spark, sf_dir)))


# ----------------------------------------------------------------- splits --

@query("group_split")
def q_group_split(spark, sf_dir):
    return S.group_split(labelled(spark, sf_dir), "group_id", 0.2).select("event_id", "is_test")


@query("leakage_overlap")
def q_leakage_overlap(spark, sf_dir):
    return round_doubles(S.leakage_overlap(S.group_split(labelled(spark, sf_dir), "group_id", 0.2), "group_id"))


@query("split_profile")
def q_split_profile(spark, sf_dir):
    sp = S.group_split(supervised(spark, sf_dir), "mmsi", 0.2)
    return S.split_profile(sp)


@query("group_folds")
def q_group_folds(spark, sf_dir):
    return S.group_folds(labelled(spark, sf_dir), "group_id", "label", 3).select("event_id", "fold")


@query("sample_search_groups")
def q_sample_search_groups(spark, sf_dir):
    return S.sample_search_groups(labelled(spark, sf_dir), "group_id", "label", 40).select("event_id")


@query("resolve_column")
def q_resolve_column(spark, sf_dir):
    """Rows per group of a table whose group column is spelled otherwise."""

    rows = labelled(spark, sf_dir).withColumnRenamed("group_id", "Group_ID")
    return rows.groupBy(F.col(R.resolve_column(rows, "group_id")).alias("group_id")).agg(F.expr("count(1) AS rows"))


@query("load_side_tables")
def q_load_side_tables(spark, sf_dir):
    """The class metrics written as CSV and read back typed, without null keys."""

    scratch = Scratch(spark, "side-tables")
    R.write_table(round_doubles(M.class_metrics(labelled(spark, sf_dir))), f"{scratch.root}/class_metrics", "csv")
    back = M.class_metrics(labelled(spark, sf_dir)).dtypes
    return R.load_side_table(spark, f"{scratch.root}/class_metrics", dict(back), [back[0][0]])


@query("metric_summary")
def q_metric_summary(spark, sf_dir):
    """Metrics of the labelled predictions and of two forecasts, written as
    nested JSON and flattened."""

    scratch = Scratch(spark, "metrics")
    cls = M.summary_metrics(labelled(spark, sf_dir)).selectExpr(
        "'classifier' AS model", "named_struct('accuracy', accuracy, 'macro_f1', macro_f1, 'weighted_f1', weighted_f1) AS metrics")
    rows = FC.constant_position(FC.dead_reckoning(supervised(spark, sf_dir), H), H)
    for name, pre in (("dead_reckoning", "dr_"), ("constant_position", "const_")):
        err = M.horizon_error(rows, H, pre).groupBy().agg(F.expr("collect_list(struct(horizon_h, mean_error_km)) AS horizons"))  # a row a horizon
        cls = cls.unionByName(err.selectExpr(f"'{name}' AS model", "horizons"), allowMissingColumns=True)
    cls.write.json(f"{scratch.root}/metrics")
    return round_doubles(R.metric_summary(spark, f"{scratch.root}/metrics"))


@query("stratified_row_split")
def q_stratified_row_split(spark, sf_dir):
    return S.stratified_row_split(labelled(spark, sf_dir), "label", "event_id", 0.2).select("event_id", "is_test")


@query("temporal_split_points")
def q_temporal_split_points(spark, sf_dir):
    return S.temporal_split_points(supervised(spark, sf_dir), 0.8).select("rid", "is_test")


@query("cap_rows_by_group")
def q_cap_rows_by_group(spark, sf_dir):
    return S.cap_rows_by_group(supervised(spark, sf_dir), "mmsi", 180000).select("mmsi", "rid")


# --------------------------------------------------------------- forecast --

H = J.HORIZONS_H


@query("dead_reckon")
def q_dead_reckon(spark, sf_dir):
    d = FC.dead_reckoning(supervised(spark, sf_dir), H)
    return round_doubles(d.select("rid", *[f"dr_{a}_{h}h" for h in H for a in ("lat", "lon")]))


@query("constant_position")
def q_constant_position(spark, sf_dir):
    d = FC.constant_position(supervised(spark, sf_dir), H)
    return round_doubles(d.select("rid", *[f"const_{a}_{h}h" for h in H for a in ("lat", "lon")]))


def baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FC.constant_position(FC.dead_reckoning(supervised(spark, sf_dir), H), H)


@query("horizon_error")
def q_horizon_error(spark, sf_dir):
    b = baselines(spark, sf_dir)
    out = M.horizon_error(b, H, "const_").selectExpr("'constant_position' AS method", "*").unionByName(
        M.horizon_error(b, H, "dr_").selectExpr("'dead_reckoning' AS method", "*"))
    return round_doubles(out)


@query("error_reduction_pct")
def q_error_reduction_pct(spark, sf_dir):
    b = baselines(spark, sf_dir)
    c = M.horizon_error(b, H, "const_").selectExpr("horizon_h", "mean_error_km AS base")
    d = M.horizon_error(b, H, "dr_").selectExpr("horizon_h", "mean_error_km AS model")
    return round_doubles(c.join(d, "horizon_h").selectExpr(
        "horizon_h", f"{M.error_reduction_pct_sql('base', 'model')} AS reduction_pct"))


@query("blend_weights")
def q_blend_weights(spark, sf_dir):
    return round_doubles(FC.blend_weights(baselines(spark, sf_dir), H, "const_"))


@query("apply_blend")
def q_apply_blend(spark, sf_dir):
    b = baselines(spark, sf_dir)
    out = FC.apply_blend(b, FC.blend_weights(b, H, "const_"), H, "const_")
    return round_doubles(out.select("rid", *[f"pred_{a}_{h}h" for h in H for a in ("lat", "lon")]))


@query("forecast_latest")
def q_forecast_latest(spark, sf_dir):
    b = baselines(spark, sf_dir)
    w = FC.blend_weights(b, H, "const_")
    pts = FC.constant_position(forecast_points(spark, sf_dir), H)
    return round_doubles(FC.forecast_latest(pts, w, H, "const_"))


@query("prediction_method")
def q_prediction_method(spark, sf_dir):
    w = FC.blend_weights(baselines(spark, sf_dir), H, "const_")
    return round_doubles(w.selectExpr("horizon_h", "weight", f"{FC.prediction_method_sql('weight')} AS method"))


@query("clip_columns")
def q_clip_columns(spark, sf_dir):
    d = FC.dead_reckoning(forecast_points(spark, sf_dir), H)
    out = FC.clip_columns(d.select("rid", "delta_hours", *[f"dr_{a}_{h}h" for h in H for a in ("lat", "lon")]), H, ("dr_",))
    return round_doubles(out)


# ------------------------------------------------------- sources / steps --

def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.raw_text_points(X.read_table(spark, sf_dir, "events"))


@query("read_points")
def q_read_points(spark, sf_dir):
    """Reports written as CSV and read back: header variants → canonical names
    (values still text)."""

    path = f"{Scratch(spark, 'csv').root}/points.csv"
    raw_text(spark, sf_dir).write.option("header", True).csv(path)
    return R.read_text_points(spark, path)


@query("coerce_types")
def q_coerce_types(spark, sf_dir):
    return round_doubles(C.coerce_types(C.project_keep(C.normalize_columns(raw_text(spark, sf_dir)))))


@query("require_columns")
def q_require_columns(spark, sf_dir):
    return C.require_columns(X.ais_points(spark, sf_dir)).select("rid")


@query("null_out_of_range")
def q_null_out_of_range(spark, sf_dir):
    return round_doubles(C.null_out_of_range(C.project_keep(X.ais_points(spark, sf_dir))))


@query("drop_missing_keys")
def q_drop_missing_keys(spark, sf_dir):
    p = C.null_out_of_range(C.project_keep(X.ais_points(spark, sf_dir)))
    return C.drop_missing_keys(p).select("rid")


@query("canonical_mmsi")
def q_canonical_mmsi(spark, sf_dir):
    return C.canonical_mmsi(C.coerce_types(X.ais_points(spark, sf_dir).select("rid", "mmsi", "ts"))).select("rid", "mmsi")


@query("dedup_points")
def q_dedup_points(spark, sf_dir):
    p = C.drop_missing_keys(C.null_out_of_range(C.project_keep(X.ais_points(spark, sf_dir))))
    return round_doubles(C.dedup_points(p).select("rid", "mmsi", "ts", "lat", "lon", "sog"))


@query("project_keep")
def q_project_keep(spark, sf_dir):
    return round_doubles(C.project_keep(X.ais_points(spark, sf_dir)))


@query("add_missing_columns")
def q_add_missing_columns(spark, sf_dir):
    p = X.ais_points(spark, sf_dir).select("rid", "mmsi", "ts", "lat", "lon")
    return round_doubles(C.add_missing_columns(p, {"sog": "double", "cog": "double", "width": "double"}))


@query("impute_group_median")
def q_impute_group_median(spark, sf_dir):
    return round_doubles(clean(spark, sf_dir).select("rid", "width", "length", "draught", "shiptype"))


@query("impute_group_mean")
def q_impute_group_mean(spark, sf_dir):
    p = X.ais_points(spark, sf_dir).select("rid", "ts", "mmsi", "lat", "lon", "sog", "cog", "width", "length", "draught")
    p = C.drop_missing_keys(C.null_out_of_range(p), ("ts", "mmsi", "lat", "lon", "sog", "cog"))
    return round_doubles(C.impute_group_mean(p).select("rid", "width", "length", "draught"))


@query("fill_constants")
def q_fill_constants(spark, sf_dir):
    return round_doubles(clean(spark, sf_dir).select("rid", "sog", "cog"))


def csv_sources(spark: SparkSession, sf_dir: str) -> str:
    """A folder of CSV sources with two headers: the even reports, and the odd
    ones without a route column."""

    t = raw_text(spark, sf_dir)
    folder = Scratch(spark, "csv").root
    t.where("CAST(rid AS BIGINT) % 2 = 0").write.option("header", True).csv(f"{folder}/even.csv")
    t.where("CAST(rid AS BIGINT) % 2 = 1").drop("Route").write.option("header", True).csv(f"{folder}/odd.csv")
    return folder


@query("merge_sources")
def q_merge_sources(spark, sf_dir):
    """CSV sources of two headers, written, listed and merged."""

    return R.merge_sources(spark, csv_sources(spark, sf_dir)).select("rid", "mmsi", "ts", "route_label")


@query("merge_report")
def q_merge_report(spark, sf_dir):
    """The merge written as CSV, with its counts from the same pass."""

    folder = csv_sources(spark, sf_dir)
    return R.write_merged(spark, folder, f"{folder}/merged.csv").drop("files")


@query("union_sources")
def q_union_sources(spark, sf_dir):
    p = X.ais_points(spark, sf_dir).select("rid", "mmsi", "ts")
    return p.where("rid % 2 = 0").unionByName(p.where("rid % 2 = 1"))


@query("new_ids_after_clean")
def q_new_ids_after_clean(spark, sf_dir):
    raw = X.ais_points(spark, sf_dir)
    before = raw.selectExpr("mmsi").distinct()
    after = V.hourly_resample(C.clean_points_hourly(raw)).select("mmsi").distinct()
    return after.join(before, "mmsi", "left_anti").selectExpr("'new' AS kind", "mmsi").unionByName(
        before.join(after, "mmsi", "left_anti").selectExpr("'dropped' AS kind", "mmsi"))


@query("format_ts_sink")
def q_format_ts_sink(spark, sf_dir):
    return R.format_ts(clean(spark, sf_dir).select("rid", "ts"))


@query("run_summary")
def q_run_summary(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return p.agg(
        F.expr("count(1) AS vessels"), F.expr("CAST(sum(CAST(is_anomaly AS INT)) AS BIGINT) AS anomalous_vessels"),
        F.expr("CAST(sum(point_count) AS BIGINT) AS clean_points"),
    ).crossJoin(anchorages(spark, sf_dir).agg(F.expr("count(1) AS anchorage_clusters")))


# ------------------------------------------------------------ scalar funcs --

@query("haversine_km")
def q_haversine_km(spark, sf_dir):
    from wakeline.functions.geo import haversine_km
    from wakeline.operators.sequence import track_scan

    p = track_scan(clean(spark, sf_dir), track_first=["lat", "lon"])
    return round_doubles(p.select("rid", haversine_km("track_first_lat", "track_first_lon", "lat", "lon").alias("km_from_start")))


@query("bearing_degrees")
def q_bearing_degrees(spark, sf_dir):
    from wakeline.functions.geo import bearing_degrees

    v = vessels(spark, sf_dir)
    return round_doubles(v.select("mmsi", bearing_degrees("start_lat", "start_lon", "end_lat", "end_lon").alias("bearing")))


@query("straightness")
def q_straightness(spark, sf_dir):
    from wakeline.functions.geo import straightness

    v = vessels(spark, sf_dir)
    return round_doubles(v.select("mmsi", straightness("displacement_km", "total_distance_km").alias("straightness_ratio")))


@query("anchorage_confidence")
def q_anchorage_confidence(spark, sf_dir):
    return round_doubles(nearest_anchorages(spark, sf_dir).select("mmsi", "anchorage_confidence"))


@query("choose_cluster_count")
def q_choose_cluster_count(spark, sf_dir):
    v = vessels(spark, sf_dir).agg(F.expr("count(1) AS vessels"))
    return v.selectExpr("vessels", f"{K.choose_cluster_count_sql('vessels')} AS clusters")


@query("label_format")
def q_label_format(spark, sf_dir):
    r = route_labels(spark, sf_dir).select("route_label").distinct()
    return r.selectExpr("route_label", "format_string('route_%02d', dense_rank() OVER (ORDER BY route_label) - 1) AS route_id")


@query("error_reduction_vs_reference")
def q_error_reduction_vs_reference(spark, sf_dir):
    return q_error_reduction_pct(spark, sf_dir)


# ----------------------------------------------------------- ship types --

def type_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = X.ais_points(spark, sf_dir).selectExpr(
        "rid", "mmsi", "navigationalstatus", "sog", "cog", "heading", "width", "length", "draught", "shiptype"
    )
    return C.load_type_features(p)


@query("load_type_features")
def q_load_type_features(spark, sf_dir):
    return round_doubles(type_rows(spark, sf_dir))


@query("trig_encode")
def q_trig_encode(spark, sf_dir):
    return round_doubles(TY.trig_encode(type_rows(spark, sf_dir)).select(
        "rid", "cog_sin", "cog_cos", "heading_sin", "heading_cos"))


@query("type_class_counts")
def q_type_class_counts(spark, sf_dir):
    return M.class_counts(type_rows(spark, sf_dir), "shiptype")


@query("route_to_type_features")
def q_route_to_type_features(spark, sf_dir):
    return round_doubles(TY.route_to_type_features(vessels(spark, sf_dir)))


@query("feature_name_clean")
def q_feature_name_clean(spark, sf_dir):
    return TY.feature_names(type_rows(spark, sf_dir))


# ------------------------------------------------------- learning jobs --
# Model fits are not SQL-expressible: these queries get a rows-only check
# plus the property tests in tests/test_models.py.

def early_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        pts = clean(spark, sf_dir)
        early = V.early_summary(pts)
        sig = T.track_signature(V.early_track(pts))
        return ML.early_feature_matrix(early, vessels(spark, sf_dir), sig)

    return stage_table(spark, "early_features", sf_dir, build)


@query("early_feature_matrix")
def q_early_feature_matrix(spark, sf_dir):
    return round_doubles(early_features(spark, sf_dir))


def scaled_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled, _ = K.scale_signature(signature(spark, sf_dir))
    return T.wide_signature(scaled, "route")


@query("route_kmeans")
def q_route_kmeans(spark, sf_dir):
    sw = scaled_wide(spark, sf_dir)
    k = K.choose_cluster_count(sw.count())
    labels, _ = ML.route_kmeans(sw, k)
    return labels


@query("route_classifier")
def q_route_classifier(spark, sf_dir):
    feats = early_features(spark, sf_dir)
    labels = known_routes(spark, sf_dir)
    return round_doubles(ML.evaluate_split(ML.route_classifier, feats, labels))


@query("route_predict")
def q_route_predict(spark, sf_dir):
    """Classifier on early evidence → predicted route, then the anomaly
    scoring against the predicted route's centroid."""

    feats = early_features(spark, sf_dir)
    labels = known_routes(spark, sf_dir)
    model = fitted((source_tag(spark, sf_dir), "route_rf"), lambda: ML.route_classifier(feats, labels))
    pred = ML.predict_route(model, feats)
    scaled, _, lab, cents = route_space(spark, sf_dir)
    dist = K.route_distance(scaled, pred.withColumnRenamed("predicted_route", "route_label"), cents)
    thr = K.anomaly_thresholds(K.route_distance(scaled, lab, cents))
    assigned = K.threshold_lookup(pred, thr)
    return round_doubles(P.score_routes(vessels(spark, sf_dir), assigned, dist))


@query("strict_holdout")
def q_strict_holdout(spark, sf_dir):
    """The classifier on held-out vessels, with the given labels and with a route
    catalog fitted on the training vessels alone."""

    feats, sig = early_features(spark, sf_dir), signature(spark, sf_dir)
    labels = known_routes(spark, sf_dir)
    return round_doubles(ML.strict_holdout(feats, sig, labels).unionByName(ML.strict_holdout(feats, sig, None)))


@query("temporal_holdout_routes")
def q_temporal_holdout_routes(spark, sf_dir):
    feats = early_features(spark, sf_dir)
    labels = known_routes(spark, sf_dir)
    return round_doubles(ML.temporal_holdout(feats, labels, vessels(spark, sf_dir).select("mmsi", "first_timestamp")))


@query("early_window_eval")
def q_early_window_eval(spark, sf_dir):
    pts = clean(spark, sf_dir)
    labels = known_routes(spark, sf_dir)
    out = None
    for hrs in (1, 3, 6, 12):
        early = V.early_summary(pts, window_hours=hrs)
        sig = T.track_signature(V.early_track(pts, window_hours=hrs))
        feats = stage_table(spark, f"early_features_{hrs}h", sf_dir,
                            lambda e=early, g=sig: ML.early_feature_matrix(e, vessels(spark, sf_dir), g))
        r = ML.evaluate_split(ML.route_classifier, feats, labels).selectExpr(f"{hrs} AS window_hours", "*")
        out = r if out is None else out.unionByName(r)
    return round_doubles(out)


def type_split(spark: SparkSession, sf_dir: str):
    """Vessel-group split of the ship-type rows, imputed with the train
    medians and class-weighted; both sides staged once (model fits make many
    passes over them)."""

    def split():
        rows = type_rows(spark, sf_dir).where("mmsi IS NOT NULL")
        return S.group_split(rows, "mmsi", 0.2)

    sp = stage_table(spark, "type_split", sf_dir, split)

    def prep(side: str):
        train_raw = sp.where("NOT is_test").drop("is_test")
        train, med = ML.prepare_type_rows(train_raw)
        if side == "train":
            return train
        test, _ = ML.prepare_type_rows(sp.where("is_test").drop("is_test"), med)
        return test

    return (stage_table(spark, "type_train", sf_dir, lambda: prep("train")),
            stage_table(spark, "type_test", sf_dir, lambda: prep("test")))


def type_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The medians that the type models' training rows were filled from."""

    type_split(spark, sf_dir)
    raw = stage_table(spark, "type_split", sf_dir, lambda: None).where("NOT is_test")
    return stage_table(spark, "type_medians", sf_dir, lambda: C.column_medians(TY.trig_encode(raw), ML.TYPE_NUMERIC))


_MODELS: dict = {}


def fitted(key: tuple, fit):
    """Fit once per (input, model) in this process; models are small. The
    input is known by its files (``source_tag``), not by its path."""

    if key not in _MODELS:
        _MODELS[key] = fit()
    return _MODELS[key]


def type_model(spark: SparkSession, sf_dir: str, kind: str):
    train, test = type_split(spark, sf_dir)
    if kind == "logistic_regression":
        train, stats = ML.standardise(train, ML.TYPE_NUMERIC)
        test, _ = ML.standardise(test, ML.TYPE_NUMERIC, stats)
    model = fitted((source_tag(spark, sf_dir), "type", kind), lambda: ML.fit_type_model(train, kind))
    return model, train, test


def type_eval(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    model, _, test = type_model(spark, sf_dir, kind)
    scored = ML.type_probabilities(model, test)
    return M.summary_metrics(scored.selectExpr("shiptype AS label", "predicted_shiptype AS prediction"))


@query("type_logistic")
def q_type_logistic(spark, sf_dir):
    return round_doubles(type_eval(spark, sf_dir, "logistic_regression"))


@query("type_forest")
def q_type_forest(spark, sf_dir):
    return round_doubles(type_eval(spark, sf_dir, "random_forest"))


@query("type_boost")
def q_type_boost(spark, sf_dir):
    """Gradient boosting for all classes at once, with all 300 rounds of the
    model, scored on the held-out rows."""

    train, test = type_split(spark, sf_dir)
    bundle = fitted((source_tag(spark, sf_dir), "type", "xgboost"), lambda: ML.type_boost(train))
    return round_doubles(M.summary_metrics(ML.boosted_types(bundle, test).selectExpr("shiptype AS label", "predicted_shiptype AS prediction")))


@query("knn_vote")
def q_knn_vote(spark, sf_dir):
    """Distance-weighted 7-nearest-neighbour vote for every held-out row."""

    train, test = type_split(spark, sf_dir)
    return round_doubles(ML.knn_vote(train, test).join(test.select("rid", "shiptype"), "rid"))


def type_vote_scored(spark: SparkSession, sf_dir: str):
    rf, _, test = type_model(spark, sf_dir, "random_forest")
    lr, _, te_s = type_model(spark, sf_dir, "logistic_regression")
    key = ["rid"]
    v = ML.vote_probabilities([ML.type_probabilities(rf, test), ML.type_probabilities(lr, te_s)], key)
    names = rf.stages[2].labels
    lab = spark.createDataFrame([(float(i), n) for i, n in enumerate(names)], "prediction double, predicted_shiptype string")
    return v.join(F.broadcast(lab), "prediction").join(test.select("rid", "shiptype"), "rid"), names


@query("type_vote")
def q_type_vote(spark, sf_dir):
    v, _ = type_vote_scored(spark, sf_dir)
    return round_doubles(M.summary_metrics(v.selectExpr("shiptype AS label", "predicted_shiptype AS prediction")))


@query("model_compare")
def q_model_compare(spark, sf_dir):
    """Candidates scored on the same vessel-group split; best by macro F1
    then accuracy."""

    rows = []
    for kind in ("logistic_regression", "random_forest"):
        m = type_eval(spark, sf_dir, kind).selectExpr(f"'{kind}' AS model_name", "*")
        rows.append(m)
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return round_doubles(out.selectExpr(
        "*", "row_number() OVER (ORDER BY macro_f1 DESC, accuracy DESC, model_name) = 1 AS selected"))


@query("isotonic_calibration")
def q_isotonic_calibration(spark, sf_dir):
    """ECE of the forest's confidence before and after one-vs-rest isotonic
    calibration fitted on the vessel holdout."""

    rf, _, test = type_model(spark, sf_dir, "random_forest")
    scored = ML.type_probabilities(rf, test).select("label", "prediction", "prob")
    scored = Scratch(spark, "calibration").write(scored, "scored")
    cal = fit_calibration(scored, len(rf.stages[2].labels)).apply(scored)
    before = ML.class_confidence(scored).selectExpr("label", "prediction", "confidence")
    after = cal.selectExpr("label", "CAST(array_position(calibrated_prob, array_max(calibrated_prob)) - 1 AS DOUBLE) AS prediction",
                           "array_max(calibrated_prob) AS confidence")
    return round_doubles(M.calibration_error(before).selectExpr("ece AS ece_before").crossJoin(
        M.calibration_error(after).selectExpr("ece AS ece_after")))


@query("class_confidence")
def q_class_confidence(spark, sf_dir):
    rf, _, test = type_model(spark, sf_dir, "random_forest")
    return round_doubles(ML.class_confidence(ML.type_probabilities(rf, test)).select("rid", "predicted_shiptype", "confidence"))


@query("attach_ship_types")
def q_attach_ship_types(spark, sf_dir):
    """Type model applied to the vessel-level route rows."""

    out = predicted_types(spark, sf_dir, TY.route_to_type_features(vessels(spark, sf_dir)))
    return round_doubles(out.selectExpr("mmsi", "predicted_shiptype", "confidence AS predicted_shiptype_probability"))


def predicted_types(spark: SparkSession, sf_dir: str, rows: DataFrame, key: str = "mmsi") -> DataFrame:
    """The forest on new rows: training medians, calibration of the holdout."""

    rf, _, test = type_model(spark, sf_dir, "random_forest")
    held = ML.type_probabilities(rf, test).drop("features", "rawPrediction", "probability")
    cal = fitted((source_tag(spark, sf_dir), "type_calibration"), lambda: fit_calibration(held, len(rf.stages[2].labels)))
    return ML.predict_type(rf, cal, type_medians(spark, sf_dir), rows.drop("shiptype"), key)


@query("predict_type")
def q_predict_type(spark, sf_dir):
    """Ship type and calibrated confidence for every row, labelled or not."""

    return round_doubles(predicted_types(spark, sf_dir, type_rows(spark, sf_dir), "rid"))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    rf, train, _ = type_model(spark, sf_dir, "random_forest")
    imp = ML.feature_importance(rf, train)
    return round_doubles(imp.selectExpr("feature AS raw_name", "importance"))


def forecast_split(spark: SparkSession, sf_dir: str):
    sp = stage_table(spark, "forecast_split", sf_dir, lambda: S.group_split(supervised(spark, sf_dir), "mmsi", 0.2))
    return sp.where("NOT is_test").drop("is_test"), sp.where("is_test").drop("is_test")


def forest_bundle(spark: SparkSession, sf_dir: str):
    train, test = forecast_split(spark, sf_dir)
    return fitted((source_tag(spark, sf_dir), "position_forest"), lambda: ML.position_forest(train, H)), test


@query("position_forest")
def q_position_forest(spark, sf_dir):
    bundle, test = forest_bundle(spark, sf_dir)
    pred = ML.predict_positions(bundle, test)
    return round_doubles(M.horizon_error(pred, H, "rf_"))


@query("forecast_eval")
def q_forecast_eval(spark, sf_dir):
    """Holdout errors of forest, dead reckoning, constant position and the
    best per-horizon blend (weights chosen on the holdout, as the reference)."""

    bundle, test = forest_bundle(spark, sf_dir)
    pred = FC.constant_position(FC.dead_reckoning(ML.predict_positions(bundle, test), H), H).cache()
    w = FC.blend_weights(pred, H, "rf_")
    out = M.horizon_error(pred, H, "rf_").selectExpr("'random_forest' AS method", "*")
    for pre, name in (("dr_", "dead_reckoning"), ("const_", "constant_position")):
        out = out.unionByName(M.horizon_error(pred, H, pre).selectExpr(f"'{name}' AS method", "*"))
    blend = w.selectExpr("'blend' AS method", "horizon_h", "error_km AS mean_error_km",
                         "CAST(NULL AS DOUBLE) AS mae_lat", "CAST(NULL AS DOUBLE) AS mae_lon")
    return round_doubles(out.unionByName(blend))


def forest_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blend weights of forest and dead reckoning, chosen on the vessel holdout."""

    bundle, test = forest_bundle(spark, sf_dir)
    return FC.blend_weights(FC.dead_reckoning(ML.predict_positions(bundle, test), H), H, "rf_")


@query("forecast_latest_forest")
def q_forecast_latest_forest(spark, sf_dir):
    """Every vessel's latest point forecast by the forest, dead reckoning and
    their blend. Only the latest points are scored."""

    bundle, _ = forest_bundle(spark, sf_dir)
    latest = ML.predict_positions(bundle, T.latest_position(forecast_points(spark, sf_dir)))
    return round_doubles(FC.forecast_latest(latest, forest_weights(spark, sf_dir), H, "rf_"))


@query("forecast_paths_forest")
def q_forecast_paths_forest(spark, sf_dir):
    """The blended forecast of every vessel as a line from its latest point."""

    return _rounded_coords(MV.forecast_paths(q_forecast_latest_forest(spark, sf_dir), predictions(spark, sf_dir)))


@query("forecast_temporal_eval")
def q_forecast_temporal_eval(spark, sf_dir):
    """Forest fitted on the first four fifths of all rows by time, scored on the
    rest, beside the baselines and the blend (weights of the vessel holdout), with
    each method's error as a share of the constant position's."""

    split = stage_table(spark, "forecast_temporal_split", sf_dir, lambda: S.temporal_split_points(supervised(spark, sf_dir), 0.8))
    train, test = (split.where(side).drop("is_test") for side in ("NOT is_test", "is_test"))
    bundle = fitted((source_tag(spark, sf_dir), "temporal_forest"), lambda: ML.position_forest(train, H))
    rows = FC.constant_position(FC.dead_reckoning(ML.predict_positions(bundle, test), H), H)
    rows = Scratch(spark, "temporal").write(FC.apply_blend(rows, forest_weights(spark, sf_dir), H, "rf_"), "scored")
    out = None
    for name, prefix in (("random_forest", "rf_"), ("dead_reckoning", "dr_"), ("constant_position", "const_"), ("blend", "pred_")):
        errors = M.horizon_error(rows, H, prefix).selectExpr(f"'{name}' AS method", "horizon_h", "mean_error_km")
        out = errors if out is None else out.unionByName(errors)
    base = out.where("method = 'constant_position'").selectExpr("horizon_h", "mean_error_km AS _base")  # a row a horizon
    return round_doubles(out.join(F.broadcast(base), "horizon_h").selectExpr(
        "method", "horizon_h", "mean_error_km", "IF(_base > 0, 100.0D * (_base - mean_error_km) / _base, 0.0D) AS error_reduction_pct"))


def q_random_search(spark, sf_dir):
    """Not registered (36 forest fits): see ``ML.random_search``."""

    train, _ = type_split(spark, sf_dir)
    return ML.random_search(train)


# ------------------------------------------------------------- map layers --

def _rounded_coords(df: DataFrame) -> DataFrame:
    """Round the coordinate pairs inside ``coordinates`` like top-level doubles."""

    from wakeline.functions.numeric import ROUND_OFFSET

    r = lambda x: f"CAST(floor({x} * 1000000.0D + {ROUND_OFFSET}D) / 1000000.0D AS DOUBLE)"
    return df.withColumn("coordinates", F.expr(f"transform(coordinates, p -> transform(p, v -> {r('v')}))"))


@query("geojson_points")
def q_geojson_points(spark, sf_dir):
    from wakeline.functions.numeric import ROUND_OFFSET

    pts = MV.point_features(predictions(spark, sf_dir)).select("mmsi", "coordinates", "predicted_route", "is_anomaly")
    r = f"CAST(floor(v * 1000000.0D + {ROUND_OFFSET}D) / 1000000.0D AS DOUBLE)"
    return pts.withColumn("coordinates", F.expr(f"transform(coordinates, v -> {r})"))


@query("geojson_route_lines")
def q_geojson_route_lines(spark, sf_dir):
    _, scaler, _, cents = route_space(spark, sf_dir)
    return _rounded_coords(MV.centre_lines(K.route_centers(cents, scaler)))


@query("route_center_lines")
def q_route_center_lines(spark, sf_dir):
    _, scaler, _, cents = route_space(spark, sf_dir)
    out = MV.route_center_lines(K.route_centers(cents, scaler), P.route_summary(predictions(spark, sf_dir)))
    return round_doubles(_rounded_coords(out))


@query("tracks_of_selected")
def q_tracks_of_selected(spark, sf_dir):
    sel = P.top_ships(predictions(spark, sf_dir))
    return MV.tracks_of(clean(spark, sf_dir), sel).select("mmsi", "rid")


@query("anomaly_track_join")
def q_anomaly_track_join(spark, sf_dir):
    anom = P.anomaly_ships(predictions(spark, sf_dir)).select("mmsi", "anomaly_score")
    return round_doubles(clean(spark, sf_dir).join(anom, "mmsi").select("mmsi", "rid", "anomaly_score"))


@query("geojson_anomaly_tracks")
def q_geojson_anomaly_tracks(spark, sf_dir):
    anom = P.anomaly_ships(predictions(spark, sf_dir))
    lines = MV.track_pieces(MV.tracks_of(clean(spark, sf_dir), anom))
    return round_doubles(_rounded_coords(lines.join(anom.select("mmsi", "anomaly_score", "predicted_route"), "mmsi")))


@query("actual_tracks")
def q_actual_tracks(spark, sf_dir):
    sel = P.top_ships(predictions(spark, sf_dir))
    return round_doubles(_rounded_coords(MV.actual_tracks(clean(spark, sf_dir), sel)))


@query("straight_tracks")
def q_straight_tracks(spark, sf_dir):
    return _rounded_coords(MV.straight_tracks(predictions(spark, sf_dir)))


@query("ship_points")
def q_ship_points(spark, sf_dir):
    p = predictions(spark, sf_dir)
    latest = MV.actual_tracks(clean(spark, sf_dir), P.top_ships(p))
    return round_doubles(MV.ship_points(p, latest))


@query("representative_vessel")
def q_representative_vessel(spark, sf_dir):
    return round_doubles(MV.representative_vessel(predictions(spark, sf_dir), clean(spark, sf_dir)))


@query("representative_track")
def q_representative_track(spark, sf_dir):
    pts = clean(spark, sf_dir)
    rep = MV.representative_vessel(predictions(spark, sf_dir), pts)
    return MV.representative_track(rep, pts).select("predicted_route", "mmsi", "ts", "piece")


@query("average_centerline")
def q_average_centerline(spark, sf_dir):
    return round_doubles(MV.average_centerline(clean(spark, sf_dir), predictions(spark, sf_dir)))


@query("forecast_paths")
def q_forecast_paths(spark, sf_dir):
    b = baselines(spark, sf_dir)
    w = FC.blend_weights(b, H, "const_")
    fc = FC.forecast_latest(FC.constant_position(forecast_points(spark, sf_dir), H), w, H, "const_")
    # draw the dead-reckoning leg (the stand-in model is the constant position)
    fc = fc.selectExpr("mmsi", "start_lat", "start_lon", *[
        f"dead_reckoning_pred_{a}_{h}h AS pred_{a}_{h}h" for h in H for a in ("lat", "lon")])
    return _rounded_coords(MV.forecast_paths(fc, predictions(spark, sf_dir)))


# -------------------------------------------------------------- streaming --

def raw_points_stage(spark: SparkSession, sf_dir: str) -> tuple[str, object]:
    df = stage_table(spark, "raw_points", sf_dir, lambda: X.ais_points(spark, sf_dir))
    return stage_path(spark, "raw_points", sf_dir), df.schema


def stream_name(kind: str, path: str) -> str:
    """A stream's name, from the folder that it reads (which is itself named by
    the input's files and the code)."""

    return f"{kind}-{hashlib.sha1(path.encode()).hexdigest()[:16]}"


@query("hourly_resample_stream")
def q_hourly_resample_stream(spark, sf_dir):
    """The hourly resample as a Structured Streaming job over the point files."""

    path, schema = raw_points_stage(spark, sf_dir)
    hours = ST.hourly_resample_stream(ST.read_point_stream(spark, path, schema))
    return round_doubles(ST.latest(ST.run_available_now(hours, stream_name("hourly", path), "update"), ["mmsi", "ts"]))


@query("stop_events_stream")
def q_stop_events_stream(spark, sf_dir):
    """Stops as a streaming job: the finished ones, and those still open."""

    cleaned = clean(spark, sf_dir)
    path = stage_path(spark, "clean_points", sf_dir)
    stops_ = ST.stop_events_stream(ST.read_point_stream(spark, path, cleaned.schema))
    closed = ST.run_available_now(stops_, stream_name("stops", path)).drop("epoch")
    return round_doubles(ST.with_open_stops(closed, cleaned))
