"""Sequence operators over vessel tracks.

All per-track order-dependent work goes through ``track_scan`` (bucketed by
vessel and day, stitched through a small per-bucket table), so no vessel's
track is ever held by one task. Results are long-form DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import bearing_sql, haversine_sql
from wakeline.operators.sequence import mark_scan, order_for, track_scan

ORDER = ("ts", "lat", "lon")
# Fixed values of the reference.
STOP_GAP_HOURS = 3.0
SLOW_SOG_KN = 1.0
SIGNATURE_POINTS = 24
TRACK_POINTS = 90
PATTERN_POINTS = 140
MAX_HOP_KM = 80.0
MOVED = "NOT (prev_lat = lat AND prev_lon = lon)"


# ------------------------------------------------------------- stops --

def stop_events(points: DataFrame, slow_sog: float = SLOW_SOG_KN, gap_hours: float = STOP_GAP_HOURS,
                key: str = "mmsi") -> DataFrame:
    """Runs of slow points (sog <= slow_sog) per vessel; a new event starts
    when the gap to the previous *slow* point exceeds ``gap_hours`` (fast
    points in between do not break an event).

    The points are numbered by ``stop_event_points`` (bucketed scans, so no task
    holds a vessel) and summed up by (vessel, event) with a partial aggregate.

    Columns: mmsi, stop_event_no, stop_event_id, start_timestamp,
    end_timestamp, duration_hours, point_count, center_lat, center_lon, mean_sog.
    """

    ev = stop_event_points(points, slow_sog, gap_hours, key).groupBy(key, "stop_event_no").agg(
        F.expr("min(ts) AS start_timestamp"),
        F.expr("max(ts) AS end_timestamp"),
        F.expr("count(1) AS point_count"),
        F.expr("avg(lat) AS center_lat"),
        F.expr("avg(lon) AS center_lon"),
        F.expr("avg(sog) AS mean_sog"),
    )
    return ev.selectExpr(
        key,
        "stop_event_no",
        f"format_string('%d_%04d', {key}, stop_event_no) AS stop_event_id",
        "start_timestamp",
        "end_timestamp",
        "greatest((unix_micros(end_timestamp) - unix_micros(start_timestamp)) / 3.6e9D, 0.0D) AS duration_hours",
        "point_count",
        "center_lat",
        "center_lon",
        "mean_sog",
    )


def stop_event_points(points: DataFrame, slow_sog: float = SLOW_SOG_KN, gap_hours: float = STOP_GAP_HOURS,
                      key: str = "mmsi") -> DataFrame:
    """Slow points labelled with their stop event number (1-based per vessel).

    One bucketed scan: a slow point whose gap to the previous one exceeds
    ``gap_hours`` is marked, and the running count of marks numbers the events.
    """

    slow = points.where(F.col("sog") <= F.lit(float(slow_sog)))
    gap_us = int(round(gap_hours * 3600 * 1e6))
    p = mark_scan(slow, f"unix_micros(ts) - unix_micros(prev_ts) > {gap_us}", prev=["ts"], first=True, key=key, order=order_for(slow))
    return p.selectExpr(*[f"`{c}`" for c in slow.columns], "_run AS stop_event_no")


# ---------------------------------------------------------- motion --

def motion_features(points: DataFrame, key: str = "mmsi") -> DataFrame:
    """Forecast features: cog sin/cos (null → 0), deltas to the previous
    point (0 on the first), delta hours (1.0 on the first) clipped to
    [0.05, 24]."""

    p = track_scan(points, key=key, order=order_for(points), prev=["lat", "lon", "ts"])
    return p.selectExpr(
        *points.columns,
        "sin(radians(coalesce(cog, 0.0D))) AS cog_sin",
        "cos(radians(coalesce(cog, 0.0D))) AS cog_cos",
        "coalesce(lat - prev_lat, 0.0D) AS delta_lat",
        "coalesce(lon - prev_lon, 0.0D) AS delta_lon",
        "least(greatest(coalesce((unix_micros(ts) - unix_micros(prev_ts)) / 3.6e9D, 1.0D), 0.05D), 24.0D)"
        " AS delta_hours",
    )


def latest_position(points: DataFrame, key: str = "mmsi", cols: Sequence[str] | None = None) -> DataFrame:
    """Last point per vessel (``max_by`` over the order: combines map-side)."""

    cols = [c for c in (cols or points.columns) if c != key]
    st = "struct(" + ", ".join(f"`{c}`" for c in cols) + ")"
    order = ", ".join(order_for(points))
    return points.groupBy(key).agg(F.expr(f"max_by({st}, struct({order})) AS _l")).selectExpr(
        key, *[f"_l.`{c}` AS `{c}`" for c in cols]
    )


# ----------------------------------------------------- map-side tracks --

def track_line_points(points: DataFrame, max_points: int = TRACK_POINTS, key: str = "mmsi") -> DataFrame:
    """The points a map line is drawn from: valid coordinates in time order,
    consecutive duplicates dropped, then down-sampled to at most
    ``max_points`` at half-even rounded even indexes, in one scan.

    Columns: key, ts, lat, lon, idx (position in the deduped track), n
    (deduped length), keep_idx (position in the output line), kept (its length).
    """

    valid = points.where(
        "lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)"
        " AND lon BETWEEN -180.0D AND 180.0D AND lat BETWEEN -90.0D AND 90.0D"
    ).select(key, "ts", "lat", "lon")
    p = mark_scan(valid, MOVED, prev=["lat", "lon"], first=True, key=key, order=ORDER)
    return _evenly(p.where("_mark").selectExpr(key, "ts", "lat", "lon", "_run - 1 AS idx", "_marks AS n"), max_points)


def dedupe_track(points: DataFrame, key: str = "mmsi") -> DataFrame:
    """Drop points whose coordinates equal the previous point's."""

    p = track_scan(points, key=key, order=order_for(points), prev=["lat", "lon"])
    return p.where("prev_lat IS NULL OR NOT (prev_lat = lat AND prev_lon = lon)").select(points.columns)


def _evenly(numbered: DataFrame, max_points: int) -> DataFrame:
    """Of rows with ``idx`` (0-based) of ``n``, at most ``max_points`` a track:
    index j survives iff ``j = round_half_even(i * (n - 1) / (N - 1))`` for some
    i < N, and i is its place ``keep_idx``. With n > N the steps are longer than
    one, so no j has two i; one of the four next to ``idx * (N - 1) / (n - 1)``
    it must be. Adds ``kept``, the number of rows left."""

    N = int(max_points)
    if N <= 1:
        return numbered.selectExpr("*", "idx AS keep_idx", "n AS kept")
    near = f"CAST(floor(idx * {N - 1} / greatest(n - 1, 1)) AS BIGINT)"
    hit = f"i BETWEEN 0 AND {N - 1} AND CAST(bround(i * (n - 1) / {N - 1}, 0) AS BIGINT) = idx"
    place = f"IF(n <= {N}, idx, try_element_at(filter(sequence({near} - 1, {near} + 2), i -> {hit}), 1))"
    return numbered.selectExpr("*", f"{place} AS keep_idx", f"least(n, {N}) AS kept").where("keep_idx IS NOT NULL")


def downsample_track(points: DataFrame, max_points: int, key: str = "mmsi") -> DataFrame:
    """Keep at most ``max_points`` per track at even indexes (``_evenly``),
    decided per row from its index and the track length (no per-track list).
    Adds idx, n, keep_idx, kept."""

    return _evenly(track_scan(points, key=key, order=ORDER, index="idx", track_count="n"), max_points)


def split_gaps(line_points: DataFrame, max_hop_km: float = MAX_HOP_KM, key: str = "mmsi") -> DataFrame:
    """Break a line where a hop exceeds ``max_hop_km``; pieces of one point are
    dropped; a track left with no piece keeps its whole line as piece 0.

    One scan: a point is alone if the hops before and after it both break (or
    are missing at the track's end), and no piece is left if every hop breaks.
    Input: ordered line points (``key, ts, lat, lon``). Output adds ``piece``.
    """

    hop = haversine_sql("prev_lat", "prev_lon", "lat", "lon")
    p = mark_scan(line_points, f"{hop} > {float(max_hop_km)}D", prev=["lat", "lon"], first=False, key=key, order=ORDER)
    broken, alone = "_marks = _rows - 1", "(_head OR _mark) AND coalesce(_next, true)"
    return p.where(f"{broken} OR NOT ({alone})").selectExpr(
        *[f"`{c}`" for c in line_points.columns], f"IF({broken}, 0, _run) AS piece")


def latest_bearing(points: DataFrame, line_points: DataFrame, key: str = "mmsi") -> DataFrame:
    """Last valid course (0..360) of the track, else the bearing between the
    line's last two points, else 0. ``line_points`` as from ``track_line_points``."""

    last_cog = points.where("cog IS NOT NULL AND NOT isnan(cog)").groupBy(key).agg(
        F.expr(f"max_by(cog, struct({', '.join(ORDER)})) AS _cog")
    )
    ends = line_points.where("keep_idx >= kept - 2").groupBy(key).agg(
        F.expr("min_by(struct(lat, lon), keep_idx) AS _a"),
        F.expr("max_by(struct(lat, lon), keep_idx) AS _b"),
        F.expr("count(1) AS _m"),
    )
    brg = bearing_sql("_a.lat", "_a.lon", "_b.lat", "_b.lon")
    return ends.join(last_cog, key, "full_outer").selectExpr(
        key,
        f"CASE WHEN _cog BETWEEN 0.0D AND 360.0D THEN _cog WHEN _m >= 2 THEN {brg} ELSE 0.0D END AS bearing",
    )


# -------------------------------------------------------- signature --

def track_signature(points: DataFrame, n_points: int = SIGNATURE_POINTS, key: str = "mmsi") -> DataFrame:
    """Fixed-length resampling of every track: ``n_points`` equally spaced
    times from first to last, positions linearly interpolated.

    Equal times keep their first point; a zero-duration track is spaced by
    row index; a single point repeats. Each surviving point emits the steps
    k whose time ``k * T / (P - 1)`` falls in ``[x_i, x_{i+1})`` — chosen in
    exact integer arithmetic on microseconds — and the last point emits step
    P - 1. Linear in rows; no per-track arrays.

    Columns: key, step, lat, lon.
    """

    P = int(n_points)
    s1 = track_scan(
        points.select(key, "ts", "lat", "lon"), key=key, order=ORDER, index="_i", prev=["ts"],
        track_first=["ts"], track_last=["ts"], track_count="_n",
    )
    s1 = s1.selectExpr(
        "*",
        "unix_micros(track_last_ts) - unix_micros(track_first_ts) AS _T_us",
    ).selectExpr(
        "*",
        "_T_us = 0 AS _by_index",
        "CASE WHEN _T_us = 0 THEN _i ELSE unix_micros(ts) - unix_micros(track_first_ts) END AS _X",
        "CASE WHEN _T_us = 0 THEN _n - 1 ELSE _T_us END AS _TT",
    ).selectExpr(
        "*",
        "CASE WHEN _by_index THEN CAST(_X AS DOUBLE) ELSE _X / 1000000.0D END AS _xs",
        "CASE WHEN _by_index THEN CAST(_TT AS DOUBLE) ELSE _TT / 1000000.0D END AS _Ts",
    )
    kept = s1.where("_by_index OR prev_ts IS NULL OR ts <> prev_ts").select(
        key, "ts", "lat", "lon", "_n", "_X", "_TT", "_xs", "_Ts"
    )
    s2 = track_scan(kept, key=key, order=ORDER, next=["_X", "_xs", "lat", "lon"]).selectExpr(
        "*",
        f"CASE WHEN _TT > 0 THEN CAST((_X * {P - 1} + _TT - 1) div _TT AS INT) END AS _klo",
        f"CASE WHEN _TT > 0 THEN CAST((next__X * {P - 1} + _TT - 1) div _TT - 1 AS INT) END AS _khi",
    )
    ks = (
        f"CASE WHEN _n = 1 THEN sequence(0, {P - 1})"
        f" WHEN next__X IS NULL THEN array({P - 1})"
        f" WHEN _klo <= _khi THEN sequence(_klo, _khi) ELSE CAST(array() AS ARRAY<INT>) END"
    )
    ex = s2.selectExpr("*", f"explode({ks}) AS step")
    t_k = f"(step * (_Ts / {P - 1}.0D))"
    interp = lambda c: (
        f"CASE WHEN next__X IS NULL OR _n = 1 THEN {c}"
        f" ELSE ((next_{c} - {c}) / (next__xs - _xs)) * ({t_k} - _xs) + {c} END"
    )
    return ex.selectExpr(key, "CAST(step AS INT) AS step", f"{interp('lat')} AS lat", f"{interp('lon')} AS lon")


def wide_signature(long_sig: DataFrame, prefix: str = "route", n_points: int = SIGNATURE_POINTS,
                   key: str = "mmsi") -> DataFrame:
    """Long signature → one row per vessel with ``<prefix>_lat_00, <prefix>_lon_00, …``."""

    cols = []
    for k in range(n_points):
        cols.append(F.expr(f"max(CASE WHEN step = {k} THEN lat END) AS {prefix}_lat_{k:02d}"))
        cols.append(F.expr(f"max(CASE WHEN step = {k} THEN lon END) AS {prefix}_lon_{k:02d}"))
    return long_sig.groupBy(key).agg(*cols)
