"""Map-layer shaping: GeoJSON-ready rows built as DataFrames.

Geometry arrays are only ever collected over bounded groups: a route's
centre line (P steps), or a vessel's down-sampled line (at most 90 / 140
points). Full-resolution tracks stay in long form (one row per point, with
its order index) and are cut into bounded pieces by the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.operators.quantiles import grouped_quantiles
from wakeline.operators.track import PATTERN_POINTS, TRACK_POINTS, split_gaps, track_line_points, track_signature

REPRESENTATIVE_FEATURES = ("start_lat", "start_lon", "end_lat", "end_lon", "duration_hours", "total_distance_km",
                           "mean_sog")
LINE_CHUNK = 1000


def point_features(predictions: DataFrame, lat: str = "end_lat", lon: str = "end_lon") -> DataFrame:
    """Point layer: every row with valid coordinates, other columns as properties."""

    valid = f"{lat} IS NOT NULL AND {lon} IS NOT NULL AND {lon} BETWEEN -180.0D AND 180.0D AND {lat} BETWEEN -90.0D AND 90.0D"
    return predictions.where(valid).selectExpr(f"array({lon}, {lat}) AS coordinates", "*")


def centre_lines(centres: DataFrame, label: str = "route_label") -> DataFrame:
    """Route centre points ordered by step → LineString coordinates (≥ 2 points)."""

    g = centres.groupBy(label).agg(F.expr("array_sort(collect_list(struct(step, lon, lat))) AS _pts"))
    return g.selectExpr(label, "transform(_pts, p -> array(p.lon, p.lat)) AS coordinates").where("size(coordinates) >= 2")


def route_center_lines(centres: DataFrame, summary: DataFrame) -> DataFrame:
    """Centre lines of the routes present in the predictions, with counts."""

    return centre_lines(centres).join(summary, "route_label")


def tracks_of(points: DataFrame, selected: DataFrame, key: str = "mmsi") -> DataFrame:
    """Points of the selected vessels (left semi join; the selection is one row per vessel)."""

    return points.join(selected.select(key), key, "left_semi")


def track_pieces(points: DataFrame, key: str = "mmsi", chunk: int = LINE_CHUNK) -> DataFrame:
    """Full-resolution track lines cut into pieces of at most ``chunk``
    points (each piece repeats the previous piece's last point so the drawn
    line is continuous). Each output row is bounded."""

    from wakeline.operators.sequence import order_for, track_scan

    base = points.select(key, "ts", "lat", "lon")
    p = track_scan(base, key=key, order=order_for(base), index="_i")
    own = p.selectExpr(key, "_i", "lon", "lat", f"_i div {chunk} AS piece")
    carry = p.where(f"_i % {chunk} = {chunk - 1}").selectExpr(key, "_i", "lon", "lat", f"_i div {chunk} + 1 AS piece")
    return own.unionByName(carry).groupBy(key, "piece").agg(
        F.expr("transform(array_sort(collect_list(struct(_i, lon, lat))), p -> array(p.lon, p.lat)) AS coordinates")
    ).where("size(coordinates) >= 2")


def actual_tracks(points: DataFrame, selected: DataFrame, max_points: int = TRACK_POINTS) -> DataFrame:
    """Per displayed vessel: the deduped, down-sampled line (≤ ``max_points``)
    and its latest point."""

    lp = track_line_points(tracks_of(points, selected), max_points)
    g = lp.groupBy("mmsi").agg(
        F.expr("transform(array_sort(collect_list(struct(keep_idx, lon, lat))), p -> array(p.lon, p.lat)) AS coordinates"),
        F.expr("max_by(struct(lon, lat), keep_idx) AS _last"),
    )
    return g.selectExpr("mmsi", "coordinates", "_last.lon AS latest_lon", "_last.lat AS latest_lat")


def straight_tracks(predictions: DataFrame) -> DataFrame:
    """Start → end fallback line."""

    return predictions.selectExpr("mmsi", "array(array(start_lon, start_lat), array(end_lon, end_lat)) AS coordinates")


def ship_points(predictions: DataFrame, latest: DataFrame) -> DataFrame:
    """Ship marker at the latest track point, else the vessel's end point."""

    j = predictions.join(latest.selectExpr("mmsi", "latest_lon", "latest_lat"), "mmsi", "left")
    return j.selectExpr(
        "mmsi", "coalesce(latest_lon, end_lon) AS lon", "coalesce(latest_lat, end_lat) AS lat",
        "predicted_route", "is_anomaly", "predicted_route_probability",
    )


def representative_vessel(predictions: DataFrame, points: DataFrame) -> DataFrame:
    """Per predicted route, the vessel (≥ 2 points) whose summary is closest
    to the route's medians: Σ |x − median| / scale − probability, scale =
    IQR, else sample std, else 1; a feature with < 2 values is skipped; a
    missing value costs 10·scale. Ties → smallest mmsi."""

    counts = points.groupBy("mmsi").agg(F.expr("count(1) AS _n")).where("_n >= 2")
    cand = predictions.join(counts.select("mmsi"), "mmsi", "left_semi")
    names = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in REPRESENTATIVE_FEATURES)
    values = cand.where("predicted_route IS NOT NULL").selectExpr("predicted_route", f"stack({len(REPRESENTATIVE_FEATURES)}, {names}) AS (name, value)")
    quartiles = grouped_quantiles(values, ["predicted_route", "name"], [0.25, 0.5, 0.75])
    pick = "max(CASE WHEN name = '{c}' AND q = {q}D THEN value END)"
    cuts = quartiles.groupBy("predicted_route").agg(*[
        F.expr(e) for c in REPRESENTATIVE_FEATURES for e in (
            f"{pick.format(c=c, q=0.5)} AS _med_{c}", f"{pick.format(c=c, q=0.75)} - {pick.format(c=c, q=0.25)} AS _iqr_{c}")])
    spread = cand.groupBy("predicted_route").agg(*[
        F.expr(e) for c in REPRESENTATIVE_FEATURES for e in (f"stddev_samp({c}) AS _sd_{c}", f"count({c}) AS _cnt_{c}")])
    st = spread.join(cuts, "predicted_route", "left")
    terms = []
    for c in REPRESENTATIVE_FEATURES:
        scale = (f"CASE WHEN _iqr_{c} IS NOT NULL AND _iqr_{c} > 0 THEN _iqr_{c} "
                 f"WHEN _sd_{c} IS NOT NULL AND _sd_{c} > 0 THEN _sd_{c} ELSE 1.0D END")
        terms.append(
            f"CASE WHEN _cnt_{c} < 2 THEN 0.0D ELSE coalesce(abs({c} - _med_{c}), ({scale}) * 10.0D) / ({scale}) END"
        )
    score = " + ".join(terms) + " - coalesce(predicted_route_probability, 0.0D)"
    scored = cand.join(st, "predicted_route").selectExpr("predicted_route", "mmsi", f"{score} AS score")
    return scored.groupBy("predicted_route").agg(
        F.expr("min_by(mmsi, struct(score, mmsi)) AS representative_mmsi"), F.expr("min(score) AS score")
    )


def representative_track(rep: DataFrame, points: DataFrame, max_points: int = PATTERN_POINTS) -> DataFrame:
    """The representative vessel's down-sampled line split at gaps (long form)."""

    lp = track_line_points(tracks_of(points, rep.selectExpr("representative_mmsi AS mmsi")), max_points)
    pieces = split_gaps(lp.select("mmsi", "ts", "lat", "lon"))
    return pieces.join(rep.selectExpr("representative_mmsi AS mmsi", "predicted_route"), "mmsi")


def average_centerline(points: DataFrame, predictions: DataFrame, n_points: int = PATTERN_POINTS) -> DataFrame:
    """Mean of every route member's resampled track per step; consecutive
    duplicate positions removed."""

    sig = track_signature(points, n_points)
    avg = sig.join(predictions.select("mmsi", "predicted_route"), "mmsi").groupBy("predicted_route", "step").agg(
        F.expr("avg(lat) AS lat"), F.expr("avg(lon) AS lon")
    )
    w = "(PARTITION BY predicted_route ORDER BY step)"
    return avg.selectExpr("*", f"lag(lat) OVER {w} AS _pl", f"lag(lon) OVER {w} AS _po").where(
        "_pl IS NULL OR NOT (_pl = lat AND _po = lon)"
    ).drop("_pl", "_po")


def forecast_paths(forecast: DataFrame, predictions: DataFrame, horizons=(1, 2, 3, 6)) -> DataFrame:
    """Start (forecast start, else the vessel's end point) followed by the
    forecast positions of the horizons present; kept with ≥ 2 distinct points
    (further apart than 1e-9 degrees: the rest is rounding)."""

    present = [h for h in horizons if f"pred_lat_{h}h" in forecast.columns]
    j = forecast.join(predictions.select("mmsi", "end_lat", "end_lon"), "mmsi")
    pts = ", ".join(["array(coalesce(start_lon, end_lon), coalesce(start_lat, end_lat))"]
                    + [f"array(pred_lon_{h}h, pred_lat_{h}h)" for h in present])
    return j.selectExpr("mmsi", f"filter(array({pts}), p -> p[0] IS NOT NULL AND p[1] IS NOT NULL) AS coordinates").where(
        "size(array_distinct(transform(coordinates, p -> transform(p, v -> round(v, 9))))) >= 2"
    )
