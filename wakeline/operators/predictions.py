"""Route predictions and the tables shaped from them (summaries, filters,
pivots, bounds). Every input is a DataFrame; small lookup tables (thresholds,
one row per route) are broadcast with their size known."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import bearing_or_zero_sql

# Fixed values of the reference.
ANOMALY_RATIO = 1.0
LOW_PROBABILITY = 0.35
SCORE_RATIO_WEIGHT = 0.75
MAX_SHIPS = 800
TOP_TYPES = 8

VESSEL_PRED_COLUMNS = (
    "mmsi", "first_timestamp", "last_timestamp", "point_count", "duration_hours", "start_lat", "start_lon",
    "end_lat", "end_lon", "total_distance_km", "mean_sog", "width", "length", "draught",
)


def anomaly_score_sql(ratio: str, probability: str) -> str:
    return f"({SCORE_RATIO_WEIGHT}D * {ratio} + {1 - SCORE_RATIO_WEIGHT}D * (1.0D - {probability}))"


def is_anomaly_sql(ratio: str, probability: str) -> str:
    return f"({ratio} > {ANOMALY_RATIO}D OR {probability} < {LOW_PROBABILITY}D)"


def score_routes(vessels: DataFrame, assigned: DataFrame, distances: DataFrame) -> DataFrame:
    """Vessel rows + predicted route, probability, distance to the route
    centroid, threshold, ratio, anomaly score and flag.

    ``assigned``: (mmsi, predicted_route, predicted_route_probability,
    route_distance_threshold); ``distances``: (mmsi, route_distance).
    """

    j = vessels.select(*VESSEL_PRED_COLUMNS).join(assigned, "mmsi").join(distances.select("mmsi", "route_distance"), "mmsi")
    ratio = "route_distance / route_distance_threshold"
    return j.selectExpr(
        *VESSEL_PRED_COLUMNS, "predicted_route", "predicted_route_probability", "route_distance",
        "route_distance_threshold", f"{ratio} AS route_distance_ratio",
        f"{anomaly_score_sql(f'({ratio})', 'predicted_route_probability')} AS anomaly_score",
        f"{is_anomaly_sql(f'({ratio})', 'predicted_route_probability')} AS is_anomaly",
    )


def attach_anchorage(predictions: DataFrame, nearest: DataFrame) -> DataFrame:
    """Left join predictions ⟕ nearest anchorage on mmsi (nulls when none)."""

    return predictions.join(nearest, "mmsi", "left")


def rank_predictions(predictions: DataFrame) -> DataFrame:
    """Anomalies first, then score descending (mmsi breaks ties)."""

    return predictions.orderBy(F.col("is_anomaly").desc(), F.col("anomaly_score").desc(), F.col("mmsi"))


def anomaly_ships(predictions: DataFrame) -> DataFrame:
    return predictions.where("is_anomaly")


def top_ships(predictions: DataFrame, max_ships: int = MAX_SHIPS) -> DataFrame:
    """At most ``max_ships`` rows by (anomaly, route probability) descending —
    a TakeOrdered (per-partition top-k, then merge)."""

    if max_ships <= 0:
        return predictions
    return predictions.orderBy(
        F.col("is_anomaly").desc(), F.col("predicted_route_probability").desc(), F.col("mmsi")
    ).limit(int(max_ships))


def filter_predictions(predictions: DataFrame, ship_type: str = "", route_label: str = "",
                       anomaly_only: bool = False) -> DataFrame:
    """Conditional filters; empty or ``__all__`` means no filter."""

    out = predictions
    if ship_type and ship_type != "__all__":
        out = out.where(F.col("predicted_shiptype") == ship_type)
    if route_label and route_label != "__all__":
        out = out.where(F.col("predicted_route") == route_label)
    if anomaly_only:
        out = out.where("is_anomaly")
    return out


def value_counts(predictions: DataFrame, column: str) -> DataFrame:
    """(name, count) with null → 'Unknown'."""

    return predictions.groupBy(F.expr(f"coalesce(CAST({column} AS STRING), 'Unknown') AS name")).agg(
        F.expr("count(1) AS count")
    )


def route_summary(predictions: DataFrame) -> DataFrame:
    """Per predicted route (null kept): vessels, anomalies, mean route and
    ship-type probability."""

    return predictions.groupBy(F.col("predicted_route").alias("route_label")).agg(
        F.expr("count(mmsi) AS vessel_count"),
        F.expr("CAST(sum(CAST(is_anomaly AS INT)) AS BIGINT) AS anomaly_count"),
        F.expr("avg(predicted_route_probability) AS avg_route_probability"),
        F.expr("avg(predicted_shiptype_probability) AS avg_shiptype_probability"),
    )


def type_route_counts(predictions: DataFrame) -> DataFrame:
    """Vessels by (predicted type, predicted route), null groups included."""

    return predictions.groupBy("predicted_shiptype", "predicted_route").agg(F.expr("count(1) AS vessel_count"))


def route_anomaly_pivot(predictions: DataFrame) -> DataFrame:
    """Normal vs anomalous vessel counts per route, plus the total."""

    p = predictions.groupBy(F.expr("coalesce(predicted_route, 'Unknown') AS route_label")).pivot(
        "is_anomaly", [False, True]
    ).agg(F.expr("count(1)"))
    return p.selectExpr(
        "route_label", "coalesce(`false`, 0) AS normal", "coalesce(`true`, 0) AS anomaly",
        "coalesce(`false`, 0) + coalesce(`true`, 0) AS total",
    )


def route_type_crosstab(predictions: DataFrame, top_n: int = TOP_TYPES) -> DataFrame:
    """Route x type counts for the ``top_n`` most frequent types (long form:
    route_label, predicted_shiptype, vessel_count; zeros included)."""

    t = predictions.selectExpr("coalesce(predicted_shiptype, 'Unknown') AS predicted_shiptype",
                               "coalesce(predicted_route, 'Unknown') AS route_label")
    top = t.groupBy("predicted_shiptype").agg(F.expr("count(1) AS n")).orderBy(
        F.col("n").desc(), F.col("predicted_shiptype")
    ).limit(int(top_n)).select("predicted_shiptype")
    routes = t.select("route_label").distinct()
    counts = t.join(top, "predicted_shiptype", "left_semi").groupBy("route_label", "predicted_shiptype").agg(
        F.expr("count(1) AS vessel_count")
    )
    # routes x top types is bounded by routes * top_n (top_n is a fixed 8)
    grid = routes.crossJoin(F.broadcast(top))
    return grid.join(counts, ["route_label", "predicted_shiptype"], "left").selectExpr(
        "route_label", "predicted_shiptype", "coalesce(vessel_count, 0) AS vessel_count"
    )


def bounds(predictions: DataFrame, centers: DataFrame) -> DataFrame:
    """[min lat, min lon, max lat, max lon] over starts, ends and centre lines."""

    pts = predictions.selectExpr("stack(2, start_lat, start_lon, end_lat, end_lon) AS (lat, lon)").unionByName(
        centers.selectExpr("lat", "lon")
    )
    return pts.agg(
        F.expr("min(lat) AS min_lat"), F.expr("min(lon) AS min_lon"),
        F.expr("max(lat) AS max_lat"), F.expr("max(lon) AS max_lon"),
    )


def anchorage_predictions(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        "mmsi", "end_lat", "end_lon", "predicted_anchorage_id", "predicted_anchorage_lat",
        "predicted_anchorage_lon", "anchorage_distance_km",
    )


def normalise_predictions(raw: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Text predictions (as read back from CSV) → typed: numbers via
    try_cast with non-finite → null, type default 'Unknown', anomaly flag
    parsed (null → false), and the start→end ``bearing`` (non-finite → 0)."""

    out = []
    for c in raw.columns:
        if c in numeric:
            out.append(f"CASE WHEN isnan(try_cast({c} AS DOUBLE)) THEN NULL ELSE try_cast({c} AS DOUBLE) END AS {c}")
        elif c == "predicted_shiptype":
            out.append(f"coalesce(nullif(trim({c}), ''), 'Unknown') AS {c}")
        elif c == "is_anomaly":
            out.append(f"coalesce(lower(trim({c})) IN ('1', 'true', 't', 'yes', 'y'), false) AS {c}")
        else:
            out.append(c)
    typed = raw.selectExpr(*out)
    return typed.selectExpr("*", f"{bearing_or_zero_sql('start_lat', 'start_lon', 'end_lat', 'end_lon')} AS bearing")
