"""Per-vessel summaries: one ``groupBy(mmsi)`` over points that already carry
the previous point (for segment lengths), plus small vessel-level joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import bearing_sql, haversine_sql, straightness_sql
from wakeline.operators.clean import key_medians
from wakeline.operators.sequence import track_scan

ORDER = ("ts", "lat", "lon")
SLOW_RATIO_SOG = 1.0  # fixed 1.0 kn, independent of the stop threshold (S10)
STATIC = ("width", "length", "draught", "shiptype")


def segment_distance(points: DataFrame, key: str = "mmsi", order: Sequence[str] = ORDER) -> DataFrame:
    """Add ``prev_lat, prev_lon, prev_ts`` and ``segment_km`` (null on a track's first point)."""

    p = track_scan(points, key=key, order=order, prev=["lat", "lon", "ts"])
    seg = haversine_sql("prev_lat", "prev_lon", "lat", "lon")
    return p.withColumn("segment_km", F.expr(f"CASE WHEN prev_lat IS NOT NULL THEN {seg} END"))


def track_features(
    points: DataFrame,
    prefix: str = "",
    key: str = "mmsi",
    order: Sequence[str] = ORDER,
    with_static: bool = True,
    observed_names: bool = False,
) -> DataFrame:
    """The reference's per-track feature set over ``points`` (full or early cut).

    ``prefix`` is prepended to every feature name (``early_``). With
    ``observed_names`` the last point is named ``observed`` instead of ``end``
    (the early cut's naming). One ``groupBy(key)`` whose aggregates all
    combine map-side (``min_by/max_by``, moments, sums).
    """

    p = segment_distance(points, key, order)
    ok = "struct(" + ", ".join(order) + ")"
    aggs = {
        "_first": f"min_by(struct(ts, lat, lon), {ok})",
        "_last": f"max_by(struct(ts, lat, lon), {ok})",
        "point_count": "count(1)",
        "mean_lat": "avg(lat)", "mean_lon": "avg(lon)",
        "std_lat": "stddev_pop(lat)", "std_lon": "stddev_pop(lon)",
        "min_lat": "min(lat)", "max_lat": "max(lat)", "min_lon": "min(lon)", "max_lon": "max(lon)",
        "mean_sog": "avg(sog)", "std_sog": "stddev_pop(sog)", "max_sog": "max(sog)",
        "slow_point_ratio": f"avg(CASE WHEN sog <= {SLOW_RATIO_SOG}D THEN 1.0D ELSE 0.0D END)",
        "mean_cog_sin": "avg(sin(radians(cog)))", "mean_cog_cos": "avg(cos(radians(cog)))",
        "total_distance_km": "coalesce(sum(segment_km), 0.0D)",
    }
    agg = p.groupBy(key).agg(*[F.expr(f"{v} AS {k}") for k, v in aggs.items()])
    end = "observed" if observed_names else "end"
    disp = haversine_sql("_first.lat", "_first.lon", "_last.lat", "_last.lon")
    brg = f"radians({bearing_sql('_first.lat', '_first.lon', '_last.lat', '_last.lon')})"
    stats = [k for k in aggs if not k.startswith("_") and k not in ("point_count", "total_distance_km")]
    feats = [
        key,
        "_first.ts AS first_timestamp",
        "_last.ts AS last_timestamp",
        "point_count",
        "greatest((unix_micros(_last.ts) - unix_micros(_first.ts)) / 3.6e9D, 0.0D) AS duration_hours",
        "_first.lat AS start_lat", "_first.lon AS start_lon",
        f"_last.lat AS {end}_lat", f"_last.lon AS {end}_lon",
        *stats,
        "total_distance_km",
        f"{disp} AS displacement_km",
        f"{straightness_sql(disp, 'total_distance_km')} AS straightness_ratio",
        f"sin({brg}) AS bearing_sin",
        f"cos({brg}) AS bearing_cos",
    ]
    out = agg.selectExpr(*feats)
    if prefix:
        out = out.selectExpr(key, *[f"{c} AS {prefix}{c}" for c in out.columns if c != key])
    if with_static:
        static = [c for c in STATIC if c in points.columns]
        if static:
            out = out.join(key_medians(points, static, key), key, "left").selectExpr(
                *out.columns, *[f"coalesce({c}, 0.0D) AS {c}" for c in static]
            )
    return out


VESSEL_COLUMNS = (
    "mmsi", "first_timestamp", "last_timestamp", "point_count", "duration_hours",
    "start_lat", "start_lon", "end_lat", "end_lon", "mean_lat", "mean_lon", "std_lat", "std_lon",
    "min_lat", "max_lat", "min_lon", "max_lon", "mean_sog", "std_sog", "max_sog", "slow_point_ratio",
    "mean_cog_sin", "mean_cog_cos", "width", "length", "draught", "shiptype",
    "total_distance_km", "displacement_km", "straightness_ratio", "bearing_sin", "bearing_cos",
)


def vessel_summary(points: DataFrame, key: str = "mmsi") -> DataFrame:
    """One row per vessel: time span, position / speed / course statistics,
    static-field medians, path length, displacement, straightness, bearing."""

    out = track_features(points, key=key)
    return out.select([c for c in VESSEL_COLUMNS if c in out.columns])


def vessel_label_mode(points: DataFrame, label: str = "route_label", key: str = "mmsi") -> DataFrame:
    """Most frequent non-null label per vessel, the smallest on a tie.

    Pre-aggregated to (vessel, label) counts first, so the per-vessel step sees
    one row per distinct label only.
    """

    counts = points.where(F.col(label).isNotNull()).groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(key).agg(F.min_by(F.col(label), F.struct(-F.col("n"), F.col(label))).alias(label))
    return best


def early_track(
    points: DataFrame,
    window_hours: float = 6.0,
    fraction: float = 0.35,
    key: str = "mmsi",
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """The early cut of every track.

    Tracks of at most 2 points are kept whole. With ``window_hours > 0``: the
    points at or before start + window, or the first two if that leaves fewer
    than 2. Otherwise by fraction (clamped to 0.05..1) of the duration, or of
    the row count (``max(2, ceil(n * f))``) when the duration is 0.

    In time order the in-window rows are a prefix, so "fewer than two in the
    window, else the window" is simply ``index < 2 OR in_window``: one scan
    and one filter, no per-vessel join.
    """

    p = track_scan(
        points, key=key, order=order, index="_idx", track_first=["ts"], track_last=["ts"], track_count="_n"
    )
    t_us = F.unix_micros("ts") - F.unix_micros("track_first_ts")
    if window_hours and window_hours > 0:
        keep = (F.col("_idx") < 2) | (t_us <= F.lit(int(round(float(window_hours) * 3.6e9))))
    else:
        f = min(max(float(fraction), 0.05), 1.0)
        dur_us = F.unix_micros("track_last_ts") - F.unix_micros("track_first_ts")
        keep = F.when(dur_us > 0, (F.col("_idx") < 2) | (t_us <= dur_us * F.lit(f))).otherwise(
            F.col("_idx") < F.greatest(F.lit(2), F.ceil(F.col("_n") * F.lit(f)))
        )
    return p.where(keep).select(points.columns)


def early_summary(points: DataFrame, window_hours: float = 6.0, fraction: float = 0.35, key: str = "mmsi") -> DataFrame:
    """``early_*`` features over the early cut (last early point = ``observed``)."""

    early = early_track(points, window_hours, fraction, key)
    out = track_features(early, prefix="early_", key=key, with_static=False, observed_names=True)
    drop = {"early_first_timestamp", "early_last_timestamp"}
    return out.select([c for c in out.columns if c not in drop])


def hourly_resample(points: DataFrame, key: str = "mmsi", every: str = "1 hour") -> DataFrame:
    """Mean of every numeric measure per vessel and hour; empty hours absent.

    A plain ``groupBy(key, date_trunc)``: partial aggregation combines each
    vessel-hour map-side, so even a hot vessel shuffles one row per hour and
    partition. Works unchanged on a streaming DataFrame (with a watermark).
    """

    measures = [c for c in ("lat", "lon", "sog", "cog", "width", "length", "draught") if c in points.columns]
    bucket = F.date_trunc("hour", "ts") if every == "1 hour" else F.window("ts", every).start
    out = points.groupBy(key, bucket.alias("ts")).agg(*[F.avg(c).alias(c) for c in measures])
    return out.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
