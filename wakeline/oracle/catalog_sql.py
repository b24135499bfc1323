"""Independent DuckDB oracles, one per registered query (plain window / group
SQL over the fixture CTEs). Floating columns are rounded with the same
``floor(x * 1e6 + 0.4999847) / 1e6`` rule as the Spark side."""

from __future__ import annotations

import re

from wakeline.oracle.fixture_sql import CLEAN_POINTS, RAW_POINTS, bearing, haversine

SQL: dict[str, str] = {}

# The early feature columns.
EARLY_BASE = (
    "early_point_count", "early_duration_hours", "early_start_lat", "early_start_lon", "early_observed_lat",
    "early_observed_lon", "early_mean_lat", "early_mean_lon", "early_std_lat", "early_std_lon", "early_min_lat",
    "early_max_lat", "early_min_lon", "early_max_lon", "early_mean_sog", "early_std_sog", "early_max_sog",
    "early_slow_point_ratio", "early_mean_cog_sin", "early_mean_cog_cos", "width", "length", "draught", "shiptype",
    "early_total_distance_km", "early_displacement_km", "early_straightness_ratio", "early_bearing_sin",
    "early_bearing_cos",
)


def r6(x: str) -> str:
    return f"CAST(floor(({x}) * 1000000.0 + 0.4999847) / 1000000.0 AS DOUBLE)"


def rounded(sql: str, doubles: list[str] | tuple[str, ...]) -> str:
    """Wrap ``sql`` and round the listed double columns."""

    if not doubles:
        return sql
    rep = ", ".join(f"{r6(c)} AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) q"


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().lstrip(",").strip() for c in ctes if c.strip())


POINT_DOUBLES = ("lat", "lon", "sog", "cog", "width", "length", "draught", "shiptype")

SQL["clean_points"] = rounded(W(CLEAN_POINTS) + "\nSELECT * FROM clean_points", POINT_DOUBLES)


def track_features_sql(src: str, prefix: str = "", static: bool = True, observed: bool = False) -> str:
    """CTE text computing the per-track features of ``src`` into ``feat``."""

    end = "observed" if observed else "end"
    hav_seg = haversine("plat", "plon", "lat", "lon")
    disp = haversine("start_lat", "start_lon", f"{end}_lat", f"{end}_lon")
    brg = bearing("start_lat", "start_lon", f"{end}_lat", f"{end}_lon")
    static_cols = (
        ", coalesce(quantile_cont(width, 0.5), 0.0) AS width, coalesce(quantile_cont(length, 0.5), 0.0) AS length,"
        " coalesce(quantile_cont(draught, 0.5), 0.0) AS draught, coalesce(quantile_cont(shiptype, 0.5), 0.0) AS shiptype"
        if static else ""
    )
    return f"""
f_lag AS (
  SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon,
         row_number() OVER w AS rn_a,
         row_number() OVER (PARTITION BY mmsi ORDER BY ts DESC, lat DESC, lon DESC) AS rn_d
  FROM {src} WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon)
),
f_seg AS (SELECT *, CASE WHEN plat IS NOT NULL THEN {hav_seg} END AS seg_km FROM f_lag),
f_agg AS (
  SELECT mmsi,
    max(CASE WHEN rn_a = 1 THEN ts END) AS first_timestamp,
    max(CASE WHEN rn_d = 1 THEN ts END) AS last_timestamp,
    count(*) AS point_count,
    max(CASE WHEN rn_a = 1 THEN lat END) AS start_lat,
    max(CASE WHEN rn_a = 1 THEN lon END) AS start_lon,
    max(CASE WHEN rn_d = 1 THEN lat END) AS {end}_lat,
    max(CASE WHEN rn_d = 1 THEN lon END) AS {end}_lon,
    avg(lat) AS mean_lat, avg(lon) AS mean_lon,
    stddev_pop(lat) AS std_lat, stddev_pop(lon) AS std_lon,
    min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon,
    avg(sog) AS mean_sog, stddev_pop(sog) AS std_sog, max(sog) AS max_sog,
    avg(CASE WHEN sog <= 1.0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS slow_point_ratio,
    avg(sin(radians(cog))) AS mean_cog_sin, avg(cos(radians(cog))) AS mean_cog_cos,
    coalesce(sum(seg_km), CAST(0 AS DOUBLE)) AS total_distance_km
    {static_cols}
  FROM f_seg GROUP BY mmsi
),
feat AS (
  SELECT mmsi, first_timestamp AS {prefix}first_timestamp, last_timestamp AS {prefix}last_timestamp,
    point_count AS {prefix}point_count,
    greatest((epoch_us(last_timestamp) - epoch_us(first_timestamp)) / 3.6e9, 0.0) AS {prefix}duration_hours,
    start_lat AS {prefix}start_lat, start_lon AS {prefix}start_lon,
    {end}_lat AS {prefix}{end}_lat, {end}_lon AS {prefix}{end}_lon,
    mean_lat AS {prefix}mean_lat, mean_lon AS {prefix}mean_lon, std_lat AS {prefix}std_lat, std_lon AS {prefix}std_lon,
    min_lat AS {prefix}min_lat, max_lat AS {prefix}max_lat, min_lon AS {prefix}min_lon, max_lon AS {prefix}max_lon,
    mean_sog AS {prefix}mean_sog, std_sog AS {prefix}std_sog, max_sog AS {prefix}max_sog,
    slow_point_ratio AS {prefix}slow_point_ratio, mean_cog_sin AS {prefix}mean_cog_sin, mean_cog_cos AS {prefix}mean_cog_cos,
    total_distance_km AS {prefix}total_distance_km,
    {disp} AS {prefix}displacement_km,
    CASE WHEN total_distance_km > 0 THEN {disp} / total_distance_km ELSE CAST(0 AS DOUBLE) END AS {prefix}straightness_ratio,
    sin(radians({brg})) AS {prefix}bearing_sin, cos(radians({brg})) AS {prefix}bearing_cos
    {", width, length, draught, shiptype" if static else ""}
  FROM f_agg
)"""


VESSEL_DOUBLES = (
    "duration_hours", "start_lat", "start_lon", "end_lat", "end_lon", "mean_lat", "mean_lon", "std_lat", "std_lon",
    "min_lat", "max_lat", "min_lon", "max_lon", "mean_sog", "std_sog", "max_sog", "slow_point_ratio",
    "mean_cog_sin", "mean_cog_cos", "width", "length", "draught", "shiptype", "total_distance_km",
    "displacement_km", "straightness_ratio", "bearing_sin", "bearing_cos",
)

SQL["vessel_summary"] = rounded(
    W(CLEAN_POINTS, track_features_sql("clean_points")) + "\nSELECT * FROM feat", VESSEL_DOUBLES
)


# ---------------------------------------------------------------- more cleaners --

HOURLY_POINTS = RAW_POINTS + """,
h_range AS (
  SELECT rid, ts,
    CASE WHEN mmsi BETWEEN 100000000 AND 999999998 THEN mmsi END AS mmsi,
    CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS lat,
    CASE WHEN lon BETWEEN -180 AND 180 THEN lon END AS lon,
    CASE WHEN sog BETWEEN 0 AND 70 THEN sog END AS sog,
    CASE WHEN cog BETWEEN 0 AND 360 THEN cog END AS cog,
    CASE WHEN width >= 0 THEN width END AS width,
    CASE WHEN length >= 0 THEN length END AS length,
    CASE WHEN draught >= 0 THEN draught END AS draught
  FROM points_src
),
h_keys AS (SELECT * FROM h_range WHERE ts IS NOT NULL AND mmsi IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
           AND sog IS NOT NULL AND cog IS NOT NULL),
h_fill1 AS (
  SELECT *, coalesce(width, avg(width) OVER (PARTITION BY mmsi)) AS w1,
         coalesce(length, avg(length) OVER (PARTITION BY mmsi)) AS l1,
         coalesce(draught, avg(draught) OVER (PARTITION BY mmsi)) AS d1
  FROM h_keys
),
h_fill AS (
  SELECT rid, ts, mmsi, lat, lon, sog, cog,
    coalesce(w1, avg(w1) OVER ()) AS width, coalesce(l1, avg(l1) OVER ()) AS length,
    coalesce(d1, avg(d1) OVER ()) AS draught
  FROM h_fill1
),
hourly_points AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ts, mmsi, lat, lon ORDER BY rid) AS rn FROM h_fill
  ) WHERE rn = 1
)"""

SQL["clean_points_hourly"] = rounded(
    W(HOURLY_POINTS) + "\nSELECT * FROM hourly_points", ("lat", "lon", "sog", "cog", "width", "length", "draught")
)

SQL["hourly_resample"] = rounded(
    W(HOURLY_POINTS) + """
SELECT mmsi, date_trunc('hour', ts) AS ts, avg(lat) AS lat, avg(lon) AS lon, avg(sog) AS sog, avg(cog) AS cog,
       avg(width) AS width, avg(length) AS length, avg(draught) AS draught
FROM hourly_points GROUP BY mmsi, date_trunc('hour', ts)""",
    ("lat", "lon", "sog", "cog", "width", "length", "draught"),
)

FORECAST_POINTS = RAW_POINTS + """,
forecast_points AS (
  SELECT rid, mmsi, ts, lat, lon, sog, cog, width, length, draught FROM points_src
  WHERE mmsi IS NOT NULL AND ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
    AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180
)"""

SQL["clean_points_forecast"] = rounded(
    W(FORECAST_POINTS) + "\nSELECT * FROM forecast_points", ("lat", "lon", "sog", "cog", "width", "length", "draught")
)

SQL["vessel_label_mode"] = W(CLEAN_POINTS) + """
SELECT mmsi, route_label FROM (
  SELECT mmsi, route_label, row_number() OVER (PARTITION BY mmsi ORDER BY n DESC, route_label) AS rk
  FROM (SELECT mmsi, route_label, count(*) AS n FROM clean_points WHERE route_label IS NOT NULL GROUP BY ALL)
) WHERE rk = 1"""

EARLY_POINTS = """
e_idx AS (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY ts, lat, lon) - 1 AS e_i,
         min(ts) OVER (PARTITION BY mmsi) AS e_t0
  FROM clean_points
),
early_points AS (
  SELECT * EXCLUDE (e_i, e_t0) FROM e_idx WHERE e_i < 2 OR epoch_us(ts) - epoch_us(e_t0) <= 21600000000
)"""

SQL["early_track"] = W(CLEAN_POINTS, EARLY_POINTS) + "\nSELECT mmsi, rid, ts FROM early_points"

EARLY_DOUBLES = tuple(
    "early_" + c for c in VESSEL_DOUBLES if c not in ("width", "length", "draught", "shiptype")
)
SQL["early_summary"] = rounded(
    W(CLEAN_POINTS, EARLY_POINTS, track_features_sql("early_points", "early_", static=False, observed=True))
    + "\nSELECT * EXCLUDE (early_first_timestamp, early_last_timestamp) FROM feat",
    tuple(c.replace("early_end_", "early_observed_") for c in EARLY_DOUBLES),
)


# ---------------------------------------------------------------- sequences --

STOP_POINTS = """
s_slow AS (SELECT * FROM clean_points WHERE sog <= 1.0),
s_lag AS (SELECT *, lag(ts) OVER (PARTITION BY mmsi ORDER BY ts, lat, lon, rid) AS pts FROM s_slow),
stop_points AS (
  SELECT *, sum(CASE WHEN pts IS NULL OR epoch_us(ts) - epoch_us(pts) > 10800000000 THEN 1 ELSE 0 END)
            OVER (PARTITION BY mmsi ORDER BY ts, lat, lon, rid ROWS UNBOUNDED PRECEDING) AS stop_event_no
  FROM s_lag
)"""

SQL["stop_events"] = W(CLEAN_POINTS, STOP_POINTS) + (
    "\nSELECT mmsi, rid, ts, CAST(stop_event_no AS BIGINT) AS stop_event_no FROM stop_points"
)

STOP_SUMMARY = STOP_POINTS + """,
stop_summary AS (
  SELECT mmsi, CAST(stop_event_no AS BIGINT) AS stop_event_no,
    printf('%d_%04d', mmsi, stop_event_no) AS stop_event_id,
    min(ts) AS start_timestamp, max(ts) AS end_timestamp,
    greatest((epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9, 0.0) AS duration_hours,
    count(*) AS point_count, avg(lat) AS center_lat, avg(lon) AS center_lon, avg(sog) AS mean_sog
  FROM stop_points GROUP BY mmsi, stop_event_no
)"""

SQL["stop_event_summary"] = rounded(
    W(CLEAN_POINTS, STOP_SUMMARY) + "\nSELECT * FROM stop_summary",
    ("duration_hours", "center_lat", "center_lon", "mean_sog"),
)

SQL["segment_distance"] = rounded(
    W(CLEAN_POINTS) + f"""
SELECT mmsi, rid, ts, CASE WHEN plat IS NOT NULL THEN {haversine('plat', 'plon', 'lat', 'lon')} END AS segment_km
FROM (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM clean_points
      WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon))""",
    ("segment_km",),
)

SQL["motion_features"] = rounded(
    W(FORECAST_POINTS) + """
SELECT mmsi, rid, sin(radians(coalesce(cog, 0.0))) AS cog_sin, cos(radians(coalesce(cog, 0.0))) AS cog_cos,
  coalesce(lat - plat, 0.0) AS delta_lat, coalesce(lon - plon, 0.0) AS delta_lon,
  least(greatest(coalesce((epoch_us(ts) - epoch_us(pts)) / 3.6e9, 1.0), 0.05), 24.0) AS delta_hours
FROM (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(ts) OVER w AS pts FROM forecast_points
      WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon, rid))""",
    ("cog_sin", "cog_cos", "delta_lat", "delta_lon", "delta_hours"),
)


def signature_sql(src: str, points: int = 24) -> str:
    """CTE ``sig`` (mmsi, step, lat, lon) of ``src`` in plain window SQL."""

    p1 = points - 1
    return f"""
g1 AS (
  SELECT mmsi, ts, lat, lon,
    row_number() OVER w - 1 AS i, lag(ts) OVER w AS pts,
    count(*) OVER (PARTITION BY mmsi) AS n,
    epoch_us(max(ts) OVER (PARTITION BY mmsi)) - epoch_us(min(ts) OVER (PARTITION BY mmsi)) AS t_us,
    epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY mmsi)) AS x_us
  FROM {src} WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon)
),
g2 AS (
  SELECT *, t_us = 0 AS by_index,
    CASE WHEN t_us = 0 THEN i ELSE x_us END AS gx,
    CASE WHEN t_us = 0 THEN n - 1 ELSE t_us END AS gt
  FROM g1
),
g3 AS (
  SELECT *,
    CASE WHEN by_index THEN CAST(gx AS DOUBLE) ELSE CAST(gx AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS xs,
    CASE WHEN by_index THEN CAST(gt AS DOUBLE) ELSE CAST(gt AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS tsec
  FROM g2 WHERE by_index OR pts IS NULL OR ts <> pts
),
g4 AS (
  SELECT *, lead(gx) OVER w AS ngx, lead(xs) OVER w AS nxs, lead(lat) OVER w AS nlat, lead(lon) OVER w AS nlon
  FROM g3 WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon)
),
g5 AS (
  SELECT *, unnest(CASE
      WHEN n = 1 THEN range(0, {points})
      WHEN ngx IS NULL THEN [{p1}]
      ELSE range((gx * {p1} + gt - 1) // gt, (ngx * {p1} + gt - 1) // gt) END) AS step
  FROM g4
),
sig AS (
  SELECT mmsi, CAST(step AS INTEGER) AS step,
    CASE WHEN ngx IS NULL OR n = 1 THEN lat
         ELSE ((nlat - lat) / (nxs - xs)) * (step * (tsec / CAST({p1} AS DOUBLE)) - xs) + lat END AS lat,
    CASE WHEN ngx IS NULL OR n = 1 THEN lon
         ELSE ((nlon - lon) / (nxs - xs)) * (step * (tsec / CAST({p1} AS DOUBLE)) - xs) + lon END AS lon
  FROM g5
)"""


SQL["track_signature"] = rounded(W(CLEAN_POINTS, signature_sql("clean_points")) + "\nSELECT * FROM sig", ("lat", "lon"))

SQL["latest_position"] = rounded(
    W(CLEAN_POINTS) + """
SELECT mmsi, ts, lat, lon, sog, cog FROM (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY ts DESC, lat DESC, lon DESC) AS rk FROM clean_points
) WHERE rk = 1""",
    ("lat", "lon", "sog", "cog"),
)

SQL["dedupe_track"] = W(FORECAST_POINTS) + """
SELECT mmsi, rid FROM (
  SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM forecast_points
  WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon, rid)
) WHERE plat IS NULL OR NOT (plat = lat AND plon = lon)"""


def downsample_sql(src: str, n_max: int, out: str = "ds") -> str:
    """CTE ``out`` (mmsi, ts, lat, lon, [cog,] idx, n, keep_idx) of ``src``."""

    return f"""
{out}_1 AS (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY ts, lat, lon) - 1 AS idx,
         count(*) OVER (PARTITION BY mmsi) AS n
  FROM {src}
),
{out}_2 AS (
  SELECT * FROM {out}_1 d
  WHERE n <= {n_max} OR idx IN (
    SELECT CAST(round_even(r.i * (d.n - 1) / {n_max - 1}, 0) AS BIGINT) FROM range(0, {n_max}) r(i))
),
{out} AS (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY ts, lat, lon) - 1 AS keep_idx FROM {out}_2
)"""


SQL["downsample_track"] = W(
    CLEAN_POINTS, "dsrc AS (SELECT mmsi, ts, lat, lon FROM clean_points)", downsample_sql("dsrc", 90)
) + "\nSELECT mmsi, ts, idx, n, keep_idx FROM ds"

LINE_POINTS = """
lp_valid AS (
  SELECT mmsi, ts, lat, lon, cog FROM clean_points
  WHERE lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)
    AND lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90
),
lp_dedup AS (
  SELECT mmsi, ts, lat, lon, cog FROM (
    SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM lp_valid
    WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon)
  ) WHERE plat IS NULL OR NOT (plat = lat AND plon = lon)
),""" + downsample_sql("lp_dedup", 90, "line_points")

SQL["split_gaps"] = W(CLEAN_POINTS, LINE_POINTS) + f"""
, sg1 AS (
  SELECT mmsi, ts, lat, lon, CASE WHEN plat IS NOT NULL AND {haversine('plat', 'plon', 'lat', 'lon')} > 80.0
                                  THEN 1 ELSE 0 END AS brk
  FROM (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM line_points
        WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon))
),
sg2 AS (SELECT *, sum(brk) OVER (PARTITION BY mmsi ORDER BY ts, lat, lon ROWS UNBOUNDED PRECEDING) AS piece FROM sg1),
sg3 AS (SELECT *, count(*) OVER (PARTITION BY mmsi, piece) AS ps FROM sg2),
sg4 AS (SELECT *, count(DISTINCT CASE WHEN ps >= 2 THEN piece END) OVER (PARTITION BY mmsi) AS np FROM sg3)
SELECT mmsi, ts, CAST(CASE WHEN np = 0 THEN 0 ELSE piece END AS BIGINT) AS piece FROM sg4 WHERE np = 0 OR ps >= 2"""

SQL["latest_bearing"] = rounded(
    W(CLEAN_POINTS, LINE_POINTS) + f"""
, lb_cog AS (
  SELECT mmsi, cog AS lcog FROM (
    SELECT mmsi, cog, row_number() OVER (PARTITION BY mmsi ORDER BY ts DESC, lat DESC, lon DESC) AS rk
    FROM clean_points WHERE cog IS NOT NULL AND NOT isnan(cog)) WHERE rk = 1
),
lb_m AS (SELECT mmsi, count(*) AS m, max(keep_idx) AS k FROM line_points GROUP BY mmsi),
lb_pts AS (
  SELECT m.mmsi, m.m, a.lat AS elat, a.lon AS elon, b.lat AS plat, b.lon AS plon
  FROM lb_m m JOIN line_points a ON a.mmsi = m.mmsi AND a.keep_idx = m.k
  LEFT JOIN line_points b ON b.mmsi = m.mmsi AND b.keep_idx = m.k - 1
)
SELECT coalesce(p.mmsi, c.mmsi) AS mmsi,
  CASE WHEN c.lcog BETWEEN 0.0 AND 360.0 THEN c.lcog
       WHEN p.m >= 2 THEN {bearing('p.plat', 'p.plon', 'p.elat', 'p.elon')} ELSE 0.0 END AS bearing
FROM lb_pts p FULL OUTER JOIN lb_cog c ON p.mmsi = c.mmsi""",
    ("bearing",),
)


# ---------------------------------------------------------------- joins --

FUTURE_TARGETS = """
ft_pts AS (SELECT mmsi, rid, ts, lat, lon FROM forecast_points),
ft_big AS (SELECT mmsi FROM ft_pts GROUP BY mmsi HAVING count(*) >= 4),
ft_tg AS (
  SELECT p.mmsi, p.rid, p.ts, p.lat, p.lon, hz.h, p.ts - to_hours(hz.h) AS kt
  FROM ft_pts p CROSS JOIN (VALUES (1), (2), (3)) hz(h)
),
ft_tr AS (SELECT *, row_number() OVER (PARTITION BY mmsi, h, kt ORDER BY lat, lon, rid) AS tr FROM ft_tg),
ft_c AS (
  SELECT l.mmsi, l.rid, t.h, t.ts AS tts, t.lat AS tlat, t.lon AS tlon,
    row_number() OVER (PARTITION BY l.mmsi, l.rid, t.h ORDER BY abs(epoch_us(t.kt) - epoch_us(l.ts)),
      CASE WHEN t.kt <= l.ts THEN 0 ELSE 1 END, CASE WHEN t.kt <= l.ts THEN -t.tr ELSE t.tr END) AS rk
  FROM ft_pts l JOIN ft_tr t ON t.mmsi = l.mmsi
   AND t.kt BETWEEN l.ts - INTERVAL 45 MINUTE AND l.ts + INTERVAL 45 MINUTE
),
future_targets AS (
  SELECT mmsi, rid,
    max(CASE WHEN h = 1 THEN tts END) AS target_timestamp_1h, max(CASE WHEN h = 1 THEN tlat END) AS target_lat_1h,
    max(CASE WHEN h = 1 THEN tlon END) AS target_lon_1h,
    max(CASE WHEN h = 2 THEN tts END) AS target_timestamp_2h, max(CASE WHEN h = 2 THEN tlat END) AS target_lat_2h,
    max(CASE WHEN h = 2 THEN tlon END) AS target_lon_2h,
    max(CASE WHEN h = 3 THEN tts END) AS target_timestamp_3h, max(CASE WHEN h = 3 THEN tlat END) AS target_lat_3h,
    max(CASE WHEN h = 3 THEN tlon END) AS target_lon_3h
  FROM ft_c WHERE rk = 1 AND mmsi IN (SELECT mmsi FROM ft_big)
  GROUP BY mmsi, rid
  HAVING count(DISTINCT h) = 3
)"""

SQL["future_targets"] = rounded(
    W(FORECAST_POINTS, FUTURE_TARGETS) + "\nSELECT * FROM future_targets",
    ("target_lat_1h", "target_lon_1h", "target_lat_2h", "target_lon_2h", "target_lat_3h", "target_lon_3h"),
)


# ------------------------------------------------------------ anchorages --

ANCHOR_EVENTS = STOP_SUMMARY + f""",
nb_ev AS (
  SELECT mmsi * 1000000 + stop_event_no AS pid, mmsi, stop_event_no, center_lat, center_lon, point_count,
         duration_hours
  FROM stop_summary
),
nb_pairs AS (
  SELECT a.pid AS a, b.pid AS b FROM nb_ev a JOIN nb_ev b
    ON {haversine('a.center_lat', 'a.center_lon', 'b.center_lat', 'b.center_lon')} <= 2.0
),
db_core AS (SELECT a AS pid FROM nb_pairs GROUP BY a HAVING count(*) >= 4),
db_edges AS (
  SELECT p.a, p.b FROM nb_pairs p JOIN db_core c1 ON p.a = c1.pid JOIN db_core c2 ON p.b = c2.pid
),
reach(node, lab) AS (
  SELECT pid, pid FROM db_core
  UNION
  SELECT e.b, r.lab FROM reach r JOIN db_edges e ON e.a = r.node
),
db_comp AS (SELECT node, min(lab) AS lab FROM reach GROUP BY node),
db_num AS (SELECT lab, CAST(dense_rank() OVER (ORDER BY lab) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT lab FROM db_comp)),
db_corecl AS (SELECT c.node AS pid, n.cluster FROM db_comp c JOIN db_num n USING (lab)),
db_border AS (
  SELECT p.a AS pid, min(cc.cluster) AS cluster FROM nb_pairs p JOIN db_corecl cc ON p.b = cc.pid
  WHERE p.a NOT IN (SELECT pid FROM db_core) GROUP BY p.a
),
db_assign AS (SELECT * FROM db_corecl UNION ALL SELECT * FROM db_border),
anchorage_events AS (
  SELECT e.*, CAST(coalesce(a.cluster, -1) AS INTEGER) AS anchorage_cluster,
    CASE WHEN a.cluster IS NOT NULL THEN printf('anchorage_%03d', a.cluster) ELSE 'noise' END AS anchorage_id
  FROM nb_ev e LEFT JOIN db_assign a USING (pid)
),
anchorages AS (
  SELECT *, CAST(row_number() OVER (ORDER BY event_count DESC, vessel_count DESC, anchorage_id) AS INTEGER) AS rank
  FROM (
    SELECT anchorage_id,
      sum(greatest(CAST(point_count AS DOUBLE), 1.0) * center_lat) / sum(greatest(CAST(point_count AS DOUBLE), 1.0)) AS center_lat,
      sum(greatest(CAST(point_count AS DOUBLE), 1.0) * center_lon) / sum(greatest(CAST(point_count AS DOUBLE), 1.0)) AS center_lon,
      count(*) AS event_count, count(DISTINCT mmsi) AS vessel_count, avg(duration_hours) AS mean_duration_hours,
      CAST(sum(point_count) AS BIGINT) AS total_stop_points
    FROM anchorage_events WHERE anchorage_cluster >= 0 GROUP BY anchorage_id
  )
)"""


def WR(*ctes: str) -> str:
    return "WITH RECURSIVE " + W(*ctes)[len("WITH "):]


SQL["anchorage_neighbors"] = W(CLEAN_POINTS, STOP_SUMMARY + f""",
nb_ev AS (SELECT mmsi * 1000000 + stop_event_no AS pid, center_lat, center_lon FROM stop_summary)""") + f"""
SELECT CAST(a.pid // 1000000 AS BIGINT) AS mmsi, CAST(a.pid % 1000000 AS BIGINT) AS stop_event_no, count(*) AS neighbours
FROM nb_ev a JOIN nb_ev b ON {haversine('a.center_lat', 'a.center_lon', 'b.center_lat', 'b.center_lon')} <= 2.0
GROUP BY a.pid"""

SQL["anchorage_dbscan"] = WR(CLEAN_POINTS, ANCHOR_EVENTS) + (
    "\nSELECT mmsi, stop_event_no, anchorage_cluster, anchorage_id FROM anchorage_events"
)

SQL["anchorage_summary"] = rounded(
    WR(CLEAN_POINTS, ANCHOR_EVENTS) + "\nSELECT * FROM anchorages",
    ("center_lat", "center_lon", "mean_duration_hours"),
)

SQL["nearest_anchorage"] = rounded(
    WR(CLEAN_POINTS, ANCHOR_EVENTS, track_features_sql("clean_points")) + f"""
SELECT mmsi, anchorage_id AS predicted_anchorage_id, center_lat AS predicted_anchorage_lat,
  center_lon AS predicted_anchorage_lon, d AS anchorage_distance_km, 1.0 / (1.0 + d / 2.0) AS anchorage_confidence
FROM (
  SELECT f.mmsi, a.anchorage_id, a.center_lat, a.center_lon, a.rank,
    {haversine('f.end_lat', 'f.end_lon', 'a.center_lat', 'a.center_lon')} AS d
  FROM feat f CROSS JOIN anchorages a
) QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY d, rank) = 1""",
    ("predicted_anchorage_lat", "predicted_anchorage_lon", "anchorage_distance_km", "anchorage_confidence"),
)


# ------------------------------------------------------------ route space --

ROUTE_SPACE = signature_sql("clean_points") + """,
sc_stats AS (
  SELECT step, avg(lat) AS mean_lat, CASE WHEN stddev_pop(lat) = 0 THEN 1.0 ELSE stddev_pop(lat) END AS scale_lat,
         avg(lon) AS mean_lon, CASE WHEN stddev_pop(lon) = 0 THEN 1.0 ELSE stddev_pop(lon) END AS scale_lon
  FROM sig GROUP BY step
),
scaled AS (
  SELECT s.mmsi, s.step, (s.lat - t.mean_lat) / t.scale_lat AS lat, (s.lon - t.mean_lon) / t.scale_lon AS lon
  FROM sig s JOIN sc_stats t USING (step)
),
rl_mode AS (
  SELECT mmsi, route_label, n FROM (
    SELECT mmsi, route_label, n, row_number() OVER (PARTITION BY mmsi ORDER BY n DESC, route_label) AS rk
    FROM (SELECT mmsi, route_label, count(*) AS n FROM clean_points WHERE route_label IS NOT NULL GROUP BY ALL)
  ) WHERE rk = 1
),
rl_tot AS (SELECT mmsi, count(*) AS t FROM clean_points WHERE route_label IS NOT NULL GROUP BY mmsi),
route_labels AS (
  SELECT v.mmsi, coalesce(m.route_label, 'unknown_route') AS route_label, coalesce(m.n / t.t, 0.0) AS label_share
  FROM (SELECT DISTINCT mmsi FROM clean_points) v LEFT JOIN rl_mode m USING (mmsi) LEFT JOIN rl_tot t USING (mmsi)
),
centroids AS (
  SELECT l.route_label, s.step, avg(s.lat) AS lat, avg(s.lon) AS lon
  FROM scaled s JOIN route_labels l USING (mmsi) GROUP BY l.route_label, s.step
),
route_dist AS (
  SELECT s.mmsi, l.route_label, sqrt(sum(pow(s.lat - c.lat, 2) + pow(s.lon - c.lon, 2))) AS route_distance
  FROM scaled s JOIN route_labels l USING (mmsi) JOIN centroids c ON c.route_label = l.route_label AND c.step = s.step
  GROUP BY s.mmsi, l.route_label
),
thresholds AS (
  SELECT route_label, quantile_cont(route_distance, 0.95) AS threshold, avg(route_distance) AS mean_distance,
         stddev_pop(route_distance) AS std_distance, count(*) AS vessels
  FROM route_dist GROUP BY route_label
  UNION ALL
  SELECT NULL, quantile_cont(route_distance, 0.95), avg(route_distance), stddev_pop(route_distance), count(*)
  FROM route_dist
)"""

SQL["scale_signature"] = rounded(W(CLEAN_POINTS, ROUTE_SPACE) + "\nSELECT * FROM scaled", ("lat", "lon"))
SQL["label_centroids"] = rounded(W(CLEAN_POINTS, ROUTE_SPACE) + "\nSELECT * FROM centroids", ("lat", "lon"))
SQL["route_centers"] = rounded(
    W(CLEAN_POINTS, ROUTE_SPACE) + """
SELECT c.route_label, c.step, c.lat * t.scale_lat + t.mean_lat AS lat, c.lon * t.scale_lon + t.mean_lon AS lon
FROM centroids c JOIN sc_stats t USING (step)""",
    ("lat", "lon"),
)
SQL["route_distance"] = rounded(W(CLEAN_POINTS, ROUTE_SPACE) + "\nSELECT * FROM route_dist", ("route_distance",))
SQL["assign_route"] = rounded(W(CLEAN_POINTS, ROUTE_SPACE) + """
SELECT mmsi, route_label, d AS route_distance FROM (
  SELECT s.mmsi, c.route_label, round(sqrt(sum(pow(s.lat - c.lat, 2) + pow(s.lon - c.lon, 2))), 9) AS d
  FROM scaled s JOIN centroids c USING (step) GROUP BY s.mmsi, c.route_label)
QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY d, route_label) = 1""", ("route_distance",))
SQL["anomaly_thresholds"] = rounded(
    W(CLEAN_POINTS, ROUTE_SPACE) + "\nSELECT * FROM thresholds", ("threshold", "mean_distance", "std_distance")
)
SQL["route_catalog"] = rounded(
    W(CLEAN_POINTS, ROUTE_SPACE, track_features_sql("clean_points")) + """
SELECT l.route_label, count(*) AS vessel_count, avg(f.start_lat) AS mean_start_lat, avg(f.start_lon) AS mean_start_lon,
  avg(f.end_lat) AS mean_end_lat, avg(f.end_lon) AS mean_end_lon, avg(f.total_distance_km) AS mean_distance_km,
  avg(f.duration_hours) AS mean_duration_hours
FROM feat f JOIN route_labels l USING (mmsi) GROUP BY l.route_label""",
    ("mean_start_lat", "mean_start_lon", "mean_end_lat", "mean_end_lon", "mean_distance_km", "mean_duration_hours"),
)
SQL["attach_labels"] = W(CLEAN_POINTS, ROUTE_SPACE, track_features_sql("clean_points")) + """
SELECT f.mmsi, f.point_count, l.route_label FROM feat f JOIN route_labels l USING (mmsi)"""


# ------------------------------------------------------------ predictions --

PREDICTIONS = """
thr_route AS (SELECT route_label, threshold FROM thresholds WHERE route_label IS NOT NULL),
thr_glob AS (SELECT threshold AS g FROM thresholds WHERE route_label IS NULL),
assigned AS (
  SELECT l.mmsi, l.route_label AS predicted_route, l.label_share AS predicted_route_probability,
    greatest(coalesce(t.threshold, greatest(g.g, 1e-9)), 1e-9) AS route_distance_threshold
  FROM route_labels l LEFT JOIN thr_route t ON t.route_label = l.route_label CROSS JOIN thr_glob g
),
near AS (
  SELECT mmsi, anchorage_id AS predicted_anchorage_id, center_lat AS predicted_anchorage_lat,
    center_lon AS predicted_anchorage_lon, d AS anchorage_distance_km, 1.0 / (1.0 + d / 2.0) AS anchorage_confidence
  FROM (
    SELECT f.mmsi, a.anchorage_id, a.center_lat, a.center_lon, a.rank,
      """ + haversine("f.end_lat", "f.end_lon", "a.center_lat", "a.center_lon") + """ AS d
    FROM feat f CROSS JOIN anchorages a
  ) QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY d, rank) = 1
),
tmode AS (
  SELECT mmsi, predicted_shiptype, predicted_shiptype_probability FROM (
    SELECT mmsi, shiptype AS predicted_shiptype, n * 1.0 / sum(n) OVER (PARTITION BY mmsi) AS predicted_shiptype_probability,
      row_number() OVER (PARTITION BY mmsi ORDER BY n DESC, shiptype) AS rk
    FROM (SELECT mmsi, shiptype, count(*) AS n FROM points_src WHERE shiptype IS NOT NULL GROUP BY ALL)
  ) WHERE rk = 1
),
predictions AS (
  SELECT f.mmsi, f.first_timestamp, f.last_timestamp, f.point_count, f.duration_hours, f.start_lat, f.start_lon,
    f.end_lat, f.end_lon, f.total_distance_km, f.mean_sog, f.width, f.length, f.draught,
    a.predicted_route, a.predicted_route_probability, d.route_distance, a.route_distance_threshold,
    d.route_distance / a.route_distance_threshold AS route_distance_ratio,
    0.75 * (d.route_distance / a.route_distance_threshold) + 0.25 * (1.0 - a.predicted_route_probability) AS anomaly_score,
    (d.route_distance / a.route_distance_threshold) > 1.0 OR a.predicted_route_probability < 0.35 AS is_anomaly,
    n.predicted_anchorage_id, n.predicted_anchorage_lat, n.predicted_anchorage_lon, n.anchorage_distance_km,
    n.anchorage_confidence, t.predicted_shiptype, t.predicted_shiptype_probability
  FROM feat f JOIN assigned a USING (mmsi) JOIN route_dist d USING (mmsi)
  LEFT JOIN near n USING (mmsi) LEFT JOIN tmode t USING (mmsi)
)"""

PRED_DOUBLES = (
    "duration_hours", "start_lat", "start_lon", "end_lat", "end_lon", "total_distance_km", "mean_sog", "width",
    "length", "draught", "predicted_route_probability", "route_distance", "route_distance_threshold",
    "route_distance_ratio", "anomaly_score", "predicted_anchorage_lat", "predicted_anchorage_lon",
    "anchorage_distance_km", "anchorage_confidence", "predicted_shiptype_probability",
)


def P_(body: str, doubles=()) -> str:
    sql = WR(CLEAN_POINTS, ANCHOR_EVENTS, ROUTE_SPACE, track_features_sql("clean_points"), PREDICTIONS) + "\n" + body
    return rounded(sql, tuple(doubles))


SQL["threshold_lookup"] = P_("SELECT mmsi, predicted_route, route_distance_threshold FROM assigned",
                             ("route_distance_threshold",))
SQL["anomaly_score"] = P_("SELECT mmsi, route_distance_ratio, anomaly_score, is_anomaly FROM predictions",
                          ("route_distance_ratio", "anomaly_score"))
SQL["attach_anchorage"] = P_("SELECT * FROM predictions", PRED_DOUBLES)
SQL["rank_predictions"] = P_("SELECT mmsi, is_anomaly, anomaly_score FROM predictions", ("anomaly_score",))
SQL["anomaly_ships"] = P_("SELECT mmsi, predicted_route, anomaly_score FROM predictions WHERE is_anomaly",
                          ("anomaly_score",))
SQL["top_ships"] = P_(
    "SELECT mmsi, is_anomaly, predicted_route_probability FROM predictions"
    " ORDER BY is_anomaly DESC, predicted_route_probability DESC, mmsi LIMIT 800",
    ("predicted_route_probability",),
)
SQL["filter_predictions"] = P_("""
SELECT 'type' AS filter, mmsi FROM predictions WHERE predicted_shiptype = 'Cargo'
UNION ALL SELECT 'route', mmsi FROM predictions WHERE predicted_route = 'lane_1'
UNION ALL SELECT 'anomaly', mmsi FROM predictions WHERE is_anomaly""")
SQL["value_counts"] = P_("""
SELECT 'shipTypes' AS kind, coalesce(predicted_shiptype, 'Unknown') AS name, count(*) AS count FROM predictions GROUP BY 2
UNION ALL
SELECT 'routes', coalesce(predicted_route, 'Unknown'), count(*) FROM predictions GROUP BY 2""")
SQL["route_summary"] = P_("""
SELECT predicted_route AS route_label, count(mmsi) AS vessel_count,
  CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_count,
  avg(predicted_route_probability) AS avg_route_probability,
  avg(predicted_shiptype_probability) AS avg_shiptype_probability
FROM predictions GROUP BY predicted_route""", ("avg_route_probability", "avg_shiptype_probability"))
SQL["type_route_counts"] = P_(
    "SELECT predicted_shiptype, predicted_route, count(*) AS vessel_count FROM predictions GROUP BY ALL"
)
SQL["route_anomaly_pivot"] = P_("""
SELECT coalesce(predicted_route, 'Unknown') AS route_label,
  count(*) FILTER (WHERE NOT is_anomaly) AS normal, count(*) FILTER (WHERE is_anomaly) AS anomaly, count(*) AS total
FROM predictions GROUP BY 1""")
SQL["route_type_crosstab"] = P_("""
, ct AS (SELECT coalesce(predicted_shiptype, 'Unknown') AS predicted_shiptype,
                coalesce(predicted_route, 'Unknown') AS route_label FROM predictions),
ct_top AS (SELECT predicted_shiptype FROM ct GROUP BY 1 ORDER BY count(*) DESC, predicted_shiptype LIMIT 8),
ct_cnt AS (SELECT route_label, predicted_shiptype, count(*) AS n FROM ct GROUP BY ALL)
SELECT r.route_label, t.predicted_shiptype, coalesce(c.n, 0) AS vessel_count
FROM (SELECT DISTINCT route_label FROM ct) r CROSS JOIN ct_top t
LEFT JOIN ct_cnt c ON c.route_label = r.route_label AND c.predicted_shiptype = t.predicted_shiptype""".lstrip().replace(
    ", ct AS", "SELECT * FROM (WITH ct AS", 1) + ")")
SQL["bounds"] = P_("""
, bp AS (
  SELECT start_lat AS lat, start_lon AS lon FROM predictions UNION ALL SELECT end_lat, end_lon FROM predictions
  UNION ALL SELECT c.lat * t.scale_lat + t.mean_lat, c.lon * t.scale_lon + t.mean_lon
  FROM centroids c JOIN sc_stats t USING (step)
)
SELECT min(lat) AS min_lat, min(lon) AS min_lon, max(lat) AS max_lat, max(lon) AS max_lon FROM bp""".lstrip().replace(
    ", bp AS", "SELECT * FROM (WITH bp AS", 1) + ")", ("min_lat", "min_lon", "max_lat", "max_lon"))
SQL["anchorage_predictions"] = P_(
    "SELECT mmsi, end_lat, end_lon, predicted_anchorage_id, predicted_anchorage_lat, predicted_anchorage_lon,"
    " anchorage_distance_km FROM predictions",
    ("end_lat", "end_lon", "predicted_anchorage_lat", "predicted_anchorage_lon", "anchorage_distance_km"),
)
SQL["normalise_predictions"] = P_(
    "SELECT CAST(mmsi AS VARCHAR) AS mmsi, coalesce(nullif(trim(predicted_shiptype), ''), 'Unknown') AS predicted_shiptype,"
    " coalesce(is_anomaly, false) AS is_anomaly, start_lat, start_lon, end_lat, end_lon, predicted_route_probability,"
    " anomaly_score, route_distance_ratio, mean_sog, width, length, draught,"
    f" coalesce({bearing('start_lat', 'start_lon', 'end_lat', 'end_lon')}, 0.0) AS bearing FROM predictions",
    ("start_lat", "start_lon", "end_lat", "end_lon", "predicted_route_probability", "anomaly_score",
     "route_distance_ratio", "mean_sog", "width", "length", "draught", "bearing"),
)
SQL["parse_bool"] = P_("SELECT CAST(mmsi AS VARCHAR) AS mmsi, coalesce(is_anomaly, false) AS is_anomaly FROM predictions")
SQL["clean_number_text"] = P_(
    "SELECT CAST(mmsi AS VARCHAR) AS mmsi, anomaly_score, mean_sog FROM predictions", ("anomaly_score", "mean_sog")
)
SQL["valid_lonlat"] = W(RAW_POINTS) + """
SELECT rid, (lon IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lon) AND NOT isnan(lat)
  AND lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90) AS valid FROM points_src"""


# ---------------------------------------------------------------- metrics --

LABELLED = """
labelled AS (
  SELECT event_id, user_id AS group_id, event_type AS label,
    CASE WHEN event_id % 7 = 0
         THEN coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), event_type)
         ELSE event_type END AS prediction,
    (event_id % 1000) / 1000 AS confidence
  FROM events
),
pc AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM labelled GROUP BY ALL),
cls AS (SELECT actual AS class FROM pc UNION SELECT predicted FROM pc),
cm AS (
  SELECT c.class,
    coalesce((SELECT sum(n) FROM pc WHERE pc.actual = c.class), 0) AS support,
    coalesce((SELECT sum(n) FROM pc WHERE pc.predicted = c.class), 0) AS npred,
    coalesce((SELECT sum(n) FROM pc WHERE pc.actual = c.class AND pc.predicted = c.class), 0) AS tp
  FROM cls c
),
class_metrics AS (
  SELECT class, precision, recall,
    CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2.0 * precision * recall / (precision + recall) END AS f1_score,
    CAST(support AS BIGINT) AS support
  FROM (SELECT class, support,
          CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS precision,
          CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM cm)
),
conf_pairs AS (
  SELECT p.actual, p.predicted, p.n AS count, s.actual_support, p.n / s.actual_support AS actual_error_rate
  FROM pc p JOIN (SELECT actual, sum(n) AS actual_support FROM pc GROUP BY actual) s USING (actual)
  WHERE p.actual <> p.predicted
)"""


def L_(body: str, doubles=()) -> str:
    return rounded(W(LABELLED) + "\n" + body, tuple(doubles))


SQL["class_counts"] = W(LABELLED) + "\nSELECT label AS class, count(*) AS rows FROM labelled GROUP BY label"
SQL["class_metrics"] = L_("SELECT * FROM class_metrics", ("precision", "recall", "f1_score"))
SQL["sorted_class_metrics"] = SQL["class_metrics"]
SQL["summary_metrics"] = L_("""
SELECT (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM labelled) AS accuracy,
  avg(f1_score) AS macro_f1, sum(f1_score * support) / sum(support) AS weighted_f1 FROM class_metrics""",
                            ("accuracy", "macro_f1", "weighted_f1"))
SQL["confusion_pairs"] = L_("SELECT * FROM conf_pairs", ("actual_error_rate",))
SQL["top_confusions"] = L_("SELECT * FROM conf_pairs ORDER BY count DESC, actual, predicted LIMIT 10",
                           ("actual_error_rate",))
SQL["confusion_matrix"] = L_("""
SELECT a.class AS actual, b.class AS predicted, coalesce(pc.n, 0) AS count,
  CASE WHEN coalesce(s.support, 0) = 0 THEN 0.0 ELSE 100.0 * coalesce(pc.n, 0) / s.support END AS row_pct
FROM cls a CROSS JOIN cls b
LEFT JOIN pc ON pc.actual = a.class AND pc.predicted = b.class
LEFT JOIN (SELECT actual, sum(n) AS support FROM pc GROUP BY actual) s ON s.actual = a.class""", ("row_pct",))
SQL["calibration_error"] = L_("""
SELECT sum(abs(acc - conf) * n) / sum(n) AS ece FROM (
  SELECT least(CAST(floor(confidence * 10) AS INTEGER), 9) AS bin, count(*) AS n,
    avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS acc, avg(confidence) AS conf
  FROM labelled GROUP BY 1)""", ("ece",))


# ----------------------------------------------------------------- splits --

def h31(c: str) -> str:
    return f"((({c}) % 2147483648) * 1103515245 + 12345) % 2147483648"


SPLIT_GROUPS = f"""
sg_groups AS (SELECT DISTINCT group_id FROM labelled),
sg_test AS (
  SELECT group_id FROM (
    SELECT group_id, row_number() OVER (ORDER BY {h31('group_id')}, group_id) AS r FROM sg_groups)
  WHERE r <= CAST(ceil(0.2 * (SELECT count(*) FROM sg_groups)) AS BIGINT)
),
sg_split AS (
  SELECT l.*, l.group_id IN (SELECT group_id FROM sg_test) AS is_test FROM labelled l
)"""

SQL["group_split"] = W(LABELLED, SPLIT_GROUPS) + "\nSELECT event_id, is_test FROM sg_split"
SQL["leakage_overlap"] = W(LABELLED, SPLIT_GROUPS) + """
SELECT CAST(sum(CASE WHEN t = 1 AND f = 0 THEN 1 ELSE 0 END) AS BIGINT) AS overlap_groups,
  CAST(sum(t) AS BIGINT) AS test_groups,
  CASE WHEN sum(t) = 0 THEN 0.0 ELSE sum(CASE WHEN t = 1 AND f = 0 THEN 1 ELSE 0 END) / sum(t) END AS overlap_ratio
FROM (SELECT group_id, max(CAST(is_test AS INTEGER)) AS t, min(CAST(is_test AS INTEGER)) AS f FROM sg_split GROUP BY 1)"""
SQL["group_folds"] = W(LABELLED) + f"""
, gf AS (
  SELECT group_id, sum(c) AS rows_, arg_min(label, (-c, label)) AS stratum
  FROM (SELECT group_id, label, count(*) AS c FROM labelled GROUP BY ALL) GROUP BY group_id
),
gd AS (
  SELECT group_id, CAST((row_number() OVER (PARTITION BY stratum ORDER BY rows_ DESC, {h31('group_id')}, group_id) - 1) % 3
    AS INTEGER) AS fold FROM gf
)
SELECT l.event_id, g.fold FROM labelled l JOIN gd g USING (group_id)""".replace("\n, gf AS", ",\ngf AS", 1)
SQL["sample_search_groups"] = W(LABELLED) + f""",
gf AS (SELECT group_id, arg_min(label, (-c, label)) AS stratum
       FROM (SELECT group_id, label, count(*) AS c FROM labelled GROUP BY ALL) GROUP BY group_id),
gn AS (SELECT count(*) AS n FROM gf),
gs AS (SELECT group_id, n, row_number() OVER (PARTITION BY stratum ORDER BY {h31('group_id')}, group_id)
         <= floor(count(*) OVER (PARTITION BY stratum) * (40.0::DOUBLE / n) + 0.5) AS kept FROM gf, gn)
SELECT l.event_id FROM labelled l JOIN gs USING (group_id) WHERE kept OR n <= 40"""
SQL["resolve_column"] = W(LABELLED) + "\nSELECT group_id, count(*) AS rows FROM labelled GROUP BY group_id"
SQL["load_side_tables"] = SQL["class_metrics"]
SQL["stratified_row_split"] = W(LABELLED) + f"""
SELECT event_id, row_number() OVER (PARTITION BY label ORDER BY {h31('event_id')}, event_id)
  <= floor(count(*) OVER (PARTITION BY label) * 0.2 + 0.5) AS is_test FROM labelled"""

SUPERVISED = FORECAST_POINTS + "," + FUTURE_TARGETS + """,
supervised AS (SELECT p.*, t.* EXCLUDE (mmsi, rid) FROM forecast_points p JOIN future_targets t USING (mmsi, rid))"""


def S_(body: str, doubles=()) -> str:
    return rounded(W(SUPERVISED) + "\n" + body, tuple(doubles))


SQL["split_profile"] = S_(f"""
, sp_g AS (SELECT DISTINCT mmsi FROM supervised),
sp_t AS (SELECT mmsi FROM (SELECT mmsi, row_number() OVER (ORDER BY {h31('mmsi')}, mmsi) AS r FROM sp_g)
         WHERE r <= CAST(ceil(0.2 * (SELECT count(*) FROM sp_g)) AS BIGINT))
SELECT mmsi IN (SELECT mmsi FROM sp_t) AS is_test, count(*) AS rows, count(DISTINCT mmsi) AS groups,
  min(ts) AS first_ts, max(ts) AS last_ts
FROM supervised GROUP BY 1""".replace("\n, sp_g AS", "SELECT * FROM (WITH sp_g AS", 1) + ")")
SQL["temporal_split_points"] = S_("""
SELECT rid, row_number() OVER (ORDER BY ts, rid) > CAST(floor(0.8 * (SELECT count(*) FROM supervised)) AS BIGINT) AS is_test
FROM supervised""")
SQL["cap_rows_by_group"] = S_(f"""
SELECT s.mmsi, s.rid FROM supervised s JOIN (
  SELECT mmsi FROM (
    SELECT mmsi, coalesce(sum(n) OVER (ORDER BY {h31('mmsi')}, mmsi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_
    FROM (SELECT mmsi, count(*) AS n FROM supervised GROUP BY mmsi)
  ) WHERE before_ < 180000
) k USING (mmsi)""")


# --------------------------------------------------------------- forecast --

def dr_sql(h: int) -> tuple[str, str]:
    speed = "least(greatest(coalesce(sog, 0.0), 0.0), 70.0)"
    ang = f"(({speed}) * 1.852 * {float(h)} / 6371.0088)"
    brg = "radians(((coalesce(cog, 0.0) % 360.0) + 360.0) % 360.0)"
    p1, l1 = "radians(lat)", "radians(lon)"
    p2 = f"asin(sin({p1}) * cos({ang}) + cos({p1}) * sin({ang}) * cos({brg}))"
    l2 = f"({l1} + atan2(sin({brg}) * sin({ang}) * cos({p1}), cos({ang}) - sin({p1}) * sin({p2})))"
    x = f"(degrees({l2}) + 180.0)"
    return f"degrees({p2})", f"((({x} % 360.0) + 360.0) % 360.0 - 180.0)"


HZ = (1, 2, 3)
DR_COLS = ", ".join(f"{dr_sql(h)[0]} AS dr_lat_{h}h, {dr_sql(h)[1]} AS dr_lon_{h}h" for h in HZ)
BASELINES = SUPERVISED + f""",
baselines AS (
  SELECT *, {DR_COLS}, {", ".join(f"lat AS const_lat_{h}h, lon AS const_lon_{h}h" for h in HZ)} FROM supervised
)"""


def B_(body: str, doubles=()) -> str:
    return rounded(W(BASELINES) + "\n" + body, tuple(doubles))


SQL["dead_reckon"] = B_(
    "SELECT rid, " + ", ".join(f"dr_lat_{h}h, dr_lon_{h}h" for h in HZ) + " FROM baselines",
    [f"dr_{a}_{h}h" for h in HZ for a in ("lat", "lon")],
)
SQL["constant_position"] = B_(
    "SELECT rid, " + ", ".join(f"const_lat_{h}h, const_lon_{h}h" for h in HZ) + " FROM baselines",
    [f"const_{a}_{h}h" for h in HZ for a in ("lat", "lon")],
)


def herr(prefix: str, method: str) -> str:
    parts = []
    for h in HZ:
        d = haversine(f"target_lat_{h}h", f"target_lon_{h}h", f"{prefix}lat_{h}h", f"{prefix}lon_{h}h")
        parts.append(
            f"SELECT '{method}' AS method, {h} AS horizon_h, avg({d}) AS mean_error_km,"
            f" avg(abs(target_lat_{h}h - {prefix}lat_{h}h)) AS mae_lat, avg(abs(target_lon_{h}h - {prefix}lon_{h}h)) AS mae_lon"
            f" FROM baselines"
        )
    return " UNION ALL ".join(parts)


SQL["horizon_error"] = B_(herr("const_", "constant_position") + " UNION ALL " + herr("dr_", "dead_reckoning"),
                          ("mean_error_km", "mae_lat", "mae_lon"))
SQL["error_reduction_pct"] = B_(f"""
SELECT c.horizon_h, CASE WHEN c.mean_error_km <= 0 THEN NULL
  ELSE (c.mean_error_km - d.mean_error_km) / c.mean_error_km * 100.0 END AS reduction_pct
FROM ({herr('const_', 'c')}) c JOIN ({herr('dr_', 'd')}) d USING (horizon_h)""", ("reduction_pct",))

BLEND = BASELINES + ",\nbw_w AS (SELECT i / 20 AS w FROM range(0, 21) r(i)),\nblend_w AS (" + " UNION ALL ".join(
    f"""SELECT {h} AS horizon_h, arg_min(w, (err, w)) AS weight, min(err) AS error_km FROM (
  SELECT w, avg({haversine(f'target_lat_{h}h', f'target_lon_{h}h', f'(w * const_lat_{h}h + (1.0 - w) * dr_lat_{h}h)',
                           f'(w * const_lon_{h}h + (1.0 - w) * dr_lon_{h}h)')}) AS err
  FROM baselines CROSS JOIN bw_w GROUP BY w)"""
    for h in HZ
) + ")"

SQL["blend_weights"] = rounded(W(BLEND) + "\nSELECT * FROM blend_w", ("weight", "error_km"))
SQL["prediction_method"] = rounded(W(BLEND) + """
SELECT horizon_h, weight, CASE WHEN weight <= 0.0 THEN 'dead_reckoning' WHEN weight >= 1.0 THEN 'random_forest'
  ELSE 'rf_dead_reckoning_blend' END AS method FROM blend_w""", ("weight",))
W_ROW = ", ".join(f"(SELECT weight FROM blend_w WHERE horizon_h = {h}) AS w{h}" for h in HZ)
SQL["apply_blend"] = rounded(W(BLEND) + f"""
SELECT rid, {", ".join(f"w{h} * const_lat_{h}h + (1.0 - w{h}) * dr_lat_{h}h AS pred_lat_{h}h, "
                       f"w{h} * const_lon_{h}h + (1.0 - w{h}) * dr_lon_{h}h AS pred_lon_{h}h" for h in HZ)}
FROM baselines CROSS JOIN (SELECT {W_ROW})""", [f"pred_{a}_{h}h" for h in HZ for a in ("lat", "lon")])


def clip_lat(x: str) -> str:
    return f"least(greatest({x}, -90.0), 90.0)"


def clip_lon(x: str) -> str:
    return f"least(greatest({x}, -180.0), 180.0)"


LATEST_COLS = []
for _h in HZ:
    LATEST_COLS += [
        f"{clip_lat(f'w{_h} * lat + (1.0 - w{_h}) * dr_lat_{_h}h')} AS pred_lat_{_h}h",
        f"{clip_lon(f'w{_h} * lon + (1.0 - w{_h}) * dr_lon_{_h}h')} AS pred_lon_{_h}h",
        f"{clip_lat('lat')} AS rf_pred_lat_{_h}h", f"{clip_lon('lon')} AS rf_pred_lon_{_h}h",
        f"{clip_lat(f'dr_lat_{_h}h')} AS dead_reckoning_pred_lat_{_h}h",
        f"{clip_lon(f'dr_lon_{_h}h')} AS dead_reckoning_pred_lon_{_h}h",
        f"w{_h} AS rf_weight_{_h}h",
        f"CASE WHEN w{_h} <= 0.0 THEN 'dead_reckoning' WHEN w{_h} >= 1.0 THEN 'random_forest'"
        f" ELSE 'rf_dead_reckoning_blend' END AS prediction_method_{_h}h",
    ]
_FORECAST = W(BLEND) + f"""
, fl_last AS (
  SELECT * FROM forecast_points QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY ts DESC, lat DESC, lon DESC, rid DESC) = 1
),
fl_dr AS (SELECT *, {DR_COLS} FROM fl_last)
SELECT mmsi, ts AS start_timestamp, lat AS start_lat, lon AS start_lon, {", ".join(LATEST_COLS)}
FROM fl_dr CROSS JOIN (SELECT {W_ROW})""".replace("\n, fl_last AS", ",\nfl_last AS", 1).replace("SELECT * FROM blend_w", "")
SQL["forecast_latest"] = rounded(_FORECAST, ["start_lat", "start_lon"] + [
    f"{p}{a}_{h}h" for h in HZ for p in ("pred_", "rf_pred_", "dead_reckoning_pred_") for a in ("lat", "lon")
] + [f"rf_weight_{h}h" for h in HZ])
SQL["clip_columns"] = rounded(W(FORECAST_POINTS) + f"""
, cc AS (
  SELECT rid, least(greatest(coalesce((epoch_us(ts) - epoch_us(pts)) / 3.6e9, 1.0), 0.05), 24.0) AS delta_hours, *
  EXCLUDE (rid)
  FROM (SELECT *, lag(ts) OVER (PARTITION BY mmsi ORDER BY ts, lat, lon, rid) AS pts FROM forecast_points)
)
SELECT rid, delta_hours, {", ".join(f"{clip_lat(dr_sql(h)[0])} AS dr_lat_{h}h, {clip_lon(dr_sql(h)[1])} AS dr_lon_{h}h" for h in HZ)}
FROM cc""".replace("\n, cc AS", ",\ncc AS", 1), ["delta_hours"] + [f"dr_{a}_{h}h" for h in HZ for a in ("lat", "lon")])


# ------------------------------------------------------- sources / steps --

def txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


SQL["read_points"] = W(RAW_POINTS) + f"""
SELECT {txt('mmsi')} AS mmsi,
  CASE WHEN rid % 37 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
  {txt('lat')} AS lat, {txt('lon')} AS lon,
  CASE WHEN rid % 31 = 0 THEN 'abc' ELSE {txt('sog')} END AS sog, {txt('cog')} AS cog,
  {txt('width')} AS width, {txt('length')} AS length, {txt('draught')} AS draught, shiptype,
  {txt('rid')} AS rid, route_label
FROM points_src"""

SQL["coerce_types"] = rounded(W(RAW_POINTS) + f"""
SELECT CAST(mmsi AS DOUBLE) AS mmsi, CASE WHEN rid % 37 = 0 THEN NULL ELSE ts END AS ts, lat, lon,
  CASE WHEN rid % 31 = 0 THEN NULL ELSE sog END AS sog, cog, width, length, draught,
  CAST(NULL AS DOUBLE) AS shiptype, {txt('rid')} AS rid, route_label
FROM points_src""", ("mmsi", "lat", "lon", "sog", "cog", "width", "length", "draught", "shiptype"))

SQL["require_columns"] = W(RAW_POINTS) + "\nSELECT rid FROM points_src"

RANGED = """
rg AS (
  SELECT CASE WHEN mmsi BETWEEN 100000000 AND 999999998 THEN mmsi END AS mmsi, ts,
    CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS lat,
    CASE WHEN lon BETWEEN -180 AND 180 THEN lon END AS lon,
    CASE WHEN sog BETWEEN 0 AND 70 THEN sog END AS sog,
    CASE WHEN cog BETWEEN 0 AND 360 THEN cog END AS cog,
    CASE WHEN width >= 0 THEN width END AS width,
    CASE WHEN length >= 0 THEN length END AS length,
    CASE WHEN draught >= 0 THEN draught END AS draught,
    shiptype, rid, route_label
  FROM points_src
)"""
SQL["null_out_of_range"] = rounded(W(RAW_POINTS, RANGED) + "\nSELECT * FROM rg",
                                   ("lat", "lon", "sog", "cog", "width", "length", "draught"))
SQL["drop_missing_keys"] = W(RAW_POINTS, RANGED) + (
    "\nSELECT rid FROM rg WHERE mmsi IS NOT NULL AND ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL"
)
SQL["canonical_mmsi"] = W(RAW_POINTS) + "\nSELECT rid, mmsi FROM points_src"
SQL["dedup_points"] = rounded(W(CLEAN_POINTS) + "\nSELECT rid, mmsi, ts, lat, lon, sog FROM c_dedup",
                              ("lat", "lon", "sog"))
SQL["project_keep"] = rounded(W(RAW_POINTS) + """
SELECT mmsi, ts, lat, lon, sog, cog, width, length, draught, shiptype, rid, route_label FROM points_src""",
                              ("lat", "lon", "sog", "cog", "width", "length", "draught"))
SQL["add_missing_columns"] = rounded(W(RAW_POINTS) + """
SELECT rid, mmsi, ts, lat, lon, CAST(NULL AS DOUBLE) AS sog, CAST(NULL AS DOUBLE) AS cog, CAST(NULL AS DOUBLE) AS width
FROM points_src""", ("lat", "lon", "sog", "cog", "width"))
SQL["impute_group_median"] = rounded(W(CLEAN_POINTS) + "\nSELECT rid, width, length, draught, shiptype FROM clean_points",
                                     ("width", "length", "draught", "shiptype"))
SQL["impute_group_mean"] = rounded(W(HOURLY_POINTS) + "\nSELECT rid, width, length, draught FROM h_fill",
                                   ("width", "length", "draught"))
SQL["fill_constants"] = rounded(W(CLEAN_POINTS) + "\nSELECT rid, sog, cog FROM clean_points", ("sog", "cog"))
SQL["merge_sources"] = W(RAW_POINTS) + f"""
SELECT {txt('rid')} AS rid, mmsi, CASE WHEN rid % 37 = 0 THEN NULL ELSE ts END AS ts,
  CASE WHEN rid % 2 = 0 THEN route_label END AS route_label
FROM points_src WHERE mmsi IS NOT NULL AND rid % 37 <> 0"""
SQL["merge_report"] = W(RAW_POINTS) + """
SELECT count(*) FILTER (WHERE mmsi IS NOT NULL AND rid % 37 <> 0) AS total_rows,
  count(DISTINCT mmsi) FILTER (WHERE mmsi IS NOT NULL AND rid % 37 <> 0) AS vessels,
  count(*) FILTER (WHERE mmsi IS NULL OR rid % 37 = 0) AS dropped_rows
FROM points_src"""
SQL["union_sources"] = W(RAW_POINTS) + "\nSELECT rid, mmsi, ts FROM points_src"
SQL["new_ids_after_clean"] = W(HOURLY_POINTS) + """
, nb AS (SELECT DISTINCT mmsi FROM points_src), na AS (SELECT DISTINCT mmsi FROM hourly_points)
SELECT 'new' AS kind, mmsi FROM na WHERE mmsi NOT IN (SELECT mmsi FROM nb)
UNION ALL SELECT 'dropped', mmsi FROM nb WHERE mmsi NOT IN (SELECT mmsi FROM na)""".replace("\n, nb AS", ",\nnb AS", 1)
SQL["format_ts_sink"] = W(CLEAN_POINTS) + "\nSELECT rid, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM clean_points"
SQL["run_summary"] = P_("""
SELECT count(*) AS vessels, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomalous_vessels,
  CAST(sum(point_count) AS BIGINT) AS clean_points, (SELECT count(*) FROM anchorages) AS anchorage_clusters
FROM predictions""")


# ------------------------------------------------------------ scalar funcs --

SQL["haversine_km"] = rounded(W(CLEAN_POINTS) + f"""
SELECT rid, {haversine('flat', 'flon', 'lat', 'lon')} AS km_from_start FROM (
  SELECT *, first_value(lat) OVER w AS flat, first_value(lon) OVER w AS flon FROM clean_points
  WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""",
                              ("km_from_start",))
FEAT = W(CLEAN_POINTS, track_features_sql("clean_points"))
SQL["bearing_degrees"] = rounded(FEAT + f"\nSELECT mmsi, {bearing('start_lat', 'start_lon', 'end_lat', 'end_lon')} AS bearing FROM feat",
                                 ("bearing",))
SQL["straightness"] = rounded(FEAT + """
SELECT mmsi, CASE WHEN total_distance_km > 0 THEN displacement_km / total_distance_km ELSE 0.0 END AS straightness_ratio
FROM feat""", ("straightness_ratio",))
SQL["anchorage_confidence"] = P_("SELECT mmsi, anchorage_confidence FROM near", ("anchorage_confidence",))
SQL["choose_cluster_count"] = FEAT + """
SELECT vessels, CAST(CASE WHEN vessels < 3 THEN greatest(1, vessels)
  ELSE least(12, greatest(3, round_even(sqrt(vessels) / 3.0, 0))) END AS BIGINT) AS clusters
FROM (SELECT count(*) AS vessels FROM feat)"""
SQL["label_format"] = W(CLEAN_POINTS, ROUTE_SPACE) + """
SELECT route_label, printf('route_%02d', dense_rank() OVER (ORDER BY route_label) - 1) AS route_id
FROM (SELECT DISTINCT route_label FROM route_labels)"""
SQL["error_reduction_vs_reference"] = SQL["error_reduction_pct"]


# ----------------------------------------------------------- ship types --

TYPE_ROWS = RAW_POINTS + """,
type_rows AS (
  SELECT CAST(rid AS DOUBLE) AS rid, mmsi, nullif(trim(navigationalstatus), '') AS navigationalstatus, sog, cog,
    heading, width, length, draught, nullif(trim(shiptype), '') AS shiptype
  FROM points_src WHERE nullif(trim(shiptype), '') IS NOT NULL
)"""
SQL["load_type_features"] = rounded(W(TYPE_ROWS) + "\nSELECT * FROM type_rows",
                                    ("rid", "sog", "cog", "heading", "width", "length", "draught"))
SQL["trig_encode"] = rounded(W(TYPE_ROWS) + """
SELECT rid, sin(radians(coalesce(cog, 0.0))) AS cog_sin, cos(radians(coalesce(cog, 0.0))) AS cog_cos,
  sin(radians(coalesce(heading, 0.0))) AS heading_sin, cos(radians(coalesce(heading, 0.0))) AS heading_cos
FROM type_rows""", ("rid", "cog_sin", "cog_cos", "heading_sin", "heading_cos"))
SQL["type_class_counts"] = W(TYPE_ROWS) + "\nSELECT shiptype AS class, count(*) AS rows FROM type_rows GROUP BY 1"
_NUM = ("sog", "cog", "heading", "width", "length", "draught", "cog_sin", "cog_cos", "heading_sin", "heading_cos")
KNN = TYPE_ROWS + f""",
kn_src AS (
  SELECT *, sin(radians(coalesce(cog, 0.0))) AS cog_sin, cos(radians(coalesce(cog, 0.0))) AS cog_cos,
    sin(radians(coalesce(heading, 0.0))) AS heading_sin, cos(radians(coalesce(heading, 0.0))) AS heading_cos
  FROM type_rows WHERE mmsi IS NOT NULL
),
kn_groups AS (SELECT DISTINCT mmsi FROM kn_src),
kn_test AS (
  SELECT mmsi FROM (SELECT mmsi, row_number() OVER (ORDER BY {h31('mmsi')}, mmsi) AS r FROM kn_groups)
  WHERE r <= CAST(ceil(0.2 * (SELECT count(*) FROM kn_groups)) AS BIGINT)
),
kn_split AS (SELECT s.*, s.mmsi IN (SELECT mmsi FROM kn_test) AS is_test FROM kn_src s),
kn_med AS (SELECT {', '.join(f"quantile_cont({c}, 0.5) AS {c}" for c in _NUM)} FROM kn_split WHERE NOT is_test),
kn_fill AS (
  SELECT s.rid, s.is_test, s.shiptype, s.navigationalstatus, {', '.join(f"coalesce(s.{c}, m.{c}, 0.0) AS {c}" for c in _NUM)}
  FROM kn_split s CROSS JOIN kn_med m
),
kn_mode AS (
  SELECT navigationalstatus AS usual FROM kn_fill WHERE NOT is_test AND navigationalstatus IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1
),
kn_scale AS (
  SELECT {', '.join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}" for c in _NUM)}
  FROM kn_fill WHERE NOT is_test
),
kn_x AS (
  SELECT rid, is_test, shiptype, coalesce(navigationalstatus, usual) AS st,
    coalesce(navigationalstatus, usual) IN (SELECT navigationalstatus FROM kn_fill WHERE NOT is_test) AS known,
    {', '.join(f"CAST(floor((({c}) - mu_{c}) / sd_{c} * 1000000.0 + 0.4999847) AS DOUBLE) AS {c}" for c in _NUM)}
  FROM kn_fill CROSS JOIN kn_scale LEFT JOIN kn_mode ON true
),
kn_d AS (
  SELECT q.rid, min({{'d2': {' + '.join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in _NUM)}
      + CASE WHEN q.st = t.st THEN 0.0 WHEN q.known THEN 2e12 ELSE 1e12 END, 't': t.rid, 'label': t.shiptype}}, 7) AS n
  FROM kn_x q JOIN kn_x t ON q.is_test AND NOT t.is_test GROUP BY q.rid
),
kn_w AS (
  SELECT rid, s.label AS label, CASE WHEN list_min(list_transform(n, lambda v: v.d2)) = 0 THEN CASE WHEN s.d2 = 0 THEN 1.0 ELSE 0.0 END
    ELSE 1.0 / sqrt(s.d2) END AS w
  FROM (SELECT rid, n, unnest(n) AS s FROM kn_d)
),
kn_vote AS (
  SELECT rid, label, round(sum(w) / sum(sum(w)) OVER (PARTITION BY rid), 9) AS p FROM kn_w GROUP BY rid, label
)"""
SQL["knn_vote"] = rounded(W(KNN) + """
SELECT v.rid, v.label AS predicted_shiptype, v.p AS probability, x.shiptype
FROM kn_vote v JOIN kn_x x USING (rid) QUALIFY row_number() OVER (PARTITION BY v.rid ORDER BY v.p DESC, v.label) = 1""",
                         ("rid", "probability"))
_B = bearing("start_lat", "start_lon", "end_lat", "end_lon")
SQL["route_to_type_features"] = rounded(FEAT + f"""
SELECT mmsi, 'Under way using engine' AS navigationalstatus, mean_sog AS sog, coalesce({_B}, 0.0) AS cog,
  coalesce({_B}, 0.0) AS heading, width, length, draught,
  sin(radians(coalesce({_B}, 0.0))) AS cog_sin, cos(radians(coalesce({_B}, 0.0))) AS cog_cos,
  sin(radians(coalesce({_B}, 0.0))) AS heading_sin, cos(radians(coalesce({_B}, 0.0))) AS heading_cos
FROM feat""", ("sog", "cog", "heading", "width", "length", "draught", "cog_sin", "cog_cos", "heading_sin", "heading_cos"))
SQL["feature_name_clean"] = W(TYPE_ROWS) + """
, fn AS (
  SELECT 'num__' || c AS raw_name FROM (VALUES ('sog'), ('cog'), ('heading'), ('width'), ('length'), ('draught'),
    ('cog_sin'), ('cog_cos'), ('heading_sin'), ('heading_cos')) v(c)
  UNION ALL
  SELECT DISTINCT 'cat__navigationalstatus_' || navigationalstatus FROM type_rows WHERE navigationalstatus IS NOT NULL
),
fc AS (
  SELECT raw_name, CASE WHEN starts_with(s, 'navigationalstatus_') THEN 'navigationalstatus=' || s[20:] ELSE s END AS feature
  FROM (SELECT raw_name, regexp_replace(raw_name, '^(num__|cat__)', '') AS s FROM fn)
)
SELECT raw_name, feature, CASE WHEN contains(feature, '=') THEN split_part(feature, '=', 1) ELSE feature END AS source_feature
FROM fc""".replace("\n, fn AS", ",\nfn AS", 1)


# ------------------------------------------------------------- map layers --

def rc(x: str) -> str:
    return r6(x)


SQL["geojson_points"] = P_(f"""
SELECT mmsi, [{rc('end_lon')}, {rc('end_lat')}] AS coordinates, predicted_route, is_anomaly FROM predictions
WHERE end_lat IS NOT NULL AND end_lon IS NOT NULL AND end_lon BETWEEN -180 AND 180 AND end_lat BETWEEN -90 AND 90""")
CENTER_LINES = """
cl_pts AS (
  SELECT c.route_label, c.step, c.lat * t.scale_lat + t.mean_lat AS lat, c.lon * t.scale_lon + t.mean_lon AS lon
  FROM centroids c JOIN sc_stats t USING (step)
),
center_lines AS (
  SELECT route_label, list([""" + rc("lon") + ", " + rc("lat") + """] ORDER BY step) AS coordinates
  FROM cl_pts GROUP BY route_label HAVING count(*) >= 2
)"""
SQL["geojson_route_lines"] = W(CLEAN_POINTS, ROUTE_SPACE, CENTER_LINES) + "\nSELECT * FROM center_lines"
SQL["route_center_lines"] = P_(", " + CENTER_LINES.strip() + """,
rs AS (
  SELECT predicted_route AS route_label, count(mmsi) AS vessel_count,
    CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_count,
    avg(predicted_route_probability) AS avg_route_probability,
    avg(predicted_shiptype_probability) AS avg_shiptype_probability
  FROM predictions GROUP BY predicted_route
)
SELECT * FROM center_lines JOIN rs USING (route_label)""", ("avg_route_probability", "avg_shiptype_probability"))
SQL["tracks_of_selected"] = P_("""
SELECT c.mmsi, c.rid FROM clean_points c WHERE c.mmsi IN (
  SELECT mmsi FROM predictions ORDER BY is_anomaly DESC, predicted_route_probability DESC, mmsi LIMIT 800)""")
SQL["anomaly_track_join"] = P_("""
SELECT c.mmsi, c.rid, p.anomaly_score FROM clean_points c JOIN predictions p ON p.mmsi = c.mmsi AND p.is_anomaly""",
                               ("anomaly_score",))
SQL["straight_tracks"] = P_(f"""
SELECT mmsi, [[{rc('start_lon')}, {rc('start_lat')}], [{rc('end_lon')}, {rc('end_lat')}]] AS coordinates FROM predictions""")
_REP = ("start_lat", "start_lon", "end_lat", "end_lon", "duration_hours", "total_distance_km", "mean_sog")
_rep_stats = ", ".join(
    f"quantile_cont({c}, 0.5) AS med_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr_{c},"
    f" stddev_samp({c}) AS sd_{c}, count({c}) AS cnt_{c}" for c in _REP
)
_rep_terms = " + ".join(
    f"CASE WHEN cnt_{c} < 2 THEN 0.0 ELSE coalesce(abs({c} - med_{c}), (CASE WHEN iqr_{c} > 0 THEN iqr_{c}"
    f" WHEN sd_{c} > 0 THEN sd_{c} ELSE 1.0 END) * 10.0) / (CASE WHEN iqr_{c} > 0 THEN iqr_{c}"
    f" WHEN sd_{c} > 0 THEN sd_{c} ELSE 1.0 END) END" for c in _REP
)
SQL["representative_vessel"] = P_(f"""
, rv_c AS (SELECT * FROM predictions WHERE mmsi IN (SELECT mmsi FROM clean_points GROUP BY mmsi HAVING count(*) >= 2)),
rv_s AS (SELECT predicted_route, {_rep_stats} FROM rv_c GROUP BY predicted_route),
rv AS (SELECT c.predicted_route, c.mmsi, {_rep_terms} - coalesce(c.predicted_route_probability, 0.0) AS score
       FROM rv_c c JOIN rv_s s USING (predicted_route))
SELECT predicted_route, arg_min(mmsi, (score, mmsi)) AS representative_mmsi, min(score) AS score
FROM rv GROUP BY predicted_route""".replace("\n, rv_c AS", "SELECT * FROM (WITH rv_c AS", 1) + ")", ("score",))


def renamed(ctes: str, prefix: str, names: str) -> str:
    """CTE text with the CTEs ``names`` (a pattern) called otherwise, for a
    second use beside the first."""

    return re.sub(rf"\b({names})\b", rf"{prefix}\1", ctes)


def lines_of(n_max: int, out: str) -> str:
    return LINE_POINTS[: LINE_POINTS.index("line_points_1")] + downsample_sql("lp_dedup", n_max, out).strip()


_SELECTED = "SELECT mmsi FROM predictions ORDER BY is_anomaly DESC, predicted_route_probability DESC, mmsi LIMIT 800"
_ACTUAL = f"""
at_lines AS (
  SELECT mmsi, list([{rc('lon')}, {rc('lat')}] ORDER BY keep_idx) AS coordinates, arg_max(lon, keep_idx) AS latest_lon, arg_max(lat, keep_idx) AS latest_lat
  FROM line_points WHERE mmsi IN ({_SELECTED}) GROUP BY mmsi
)"""
SQL["actual_tracks"] = P_(",\n" + LINE_POINTS.strip() + ",\n" + _ACTUAL + "\nSELECT * FROM at_lines", ("latest_lon", "latest_lat"))
SQL["ship_points"] = P_(",\n" + LINE_POINTS.strip() + ",\n" + _ACTUAL + """
SELECT p.mmsi, coalesce(latest_lon, end_lon) AS lon, coalesce(latest_lat, end_lat) AS lat, predicted_route, is_anomaly, predicted_route_probability
FROM predictions p LEFT JOIN at_lines l USING (mmsi)""", ("lon", "lat", "predicted_route_probability"))
SQL["representative_track"] = P_(f""",
rv_c AS (SELECT * FROM predictions WHERE mmsi IN (SELECT mmsi FROM clean_points GROUP BY mmsi HAVING count(*) >= 2)),
rv_s AS (SELECT predicted_route, {_rep_stats} FROM rv_c GROUP BY predicted_route),
rv AS (SELECT c.predicted_route, c.mmsi, {_rep_terms} - coalesce(c.predicted_route_probability, 0.0) AS score
       FROM rv_c c JOIN rv_s s USING (predicted_route)),
rep AS (SELECT predicted_route, arg_min(mmsi, (score, mmsi)) AS mmsi FROM rv GROUP BY predicted_route),
{lines_of(140, "rep_line").strip()},
rt1 AS (
  SELECT mmsi, ts, CASE WHEN plat IS NOT NULL AND {haversine('plat', 'plon', 'lat', 'lon')} > 80.0 THEN 1 ELSE 0 END AS brk
  FROM (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM rep_line WHERE mmsi IN (SELECT mmsi FROM rep)
        WINDOW w AS (PARTITION BY mmsi ORDER BY ts, lat, lon))
),
rt2 AS (SELECT *, sum(brk) OVER (PARTITION BY mmsi ORDER BY ts ROWS UNBOUNDED PRECEDING) AS piece FROM rt1),
rt3 AS (SELECT *, count(*) OVER (PARTITION BY mmsi, piece) AS ps FROM rt2),
rt4 AS (SELECT *, count(DISTINCT CASE WHEN ps >= 2 THEN piece END) OVER (PARTITION BY mmsi) AS np FROM rt3)
SELECT predicted_route, mmsi, ts, CAST(CASE WHEN np = 0 THEN 0 ELSE piece END AS BIGINT) AS piece
FROM rt4 JOIN rep USING (mmsi) WHERE np = 0 OR ps >= 2""")
SQL["average_centerline"] = P_(",\n" + renamed(signature_sql("clean_points", 140), "ac_", "g[1-5]|sig").strip() + """,
ac AS (SELECT predicted_route, step, avg(lat) AS lat, avg(lon) AS lon FROM ac_sig JOIN predictions USING (mmsi) GROUP BY predicted_route, step)
SELECT predicted_route, step, lat, lon FROM (
  SELECT *, lag(lat) OVER w AS pl, lag(lon) OVER w AS po FROM ac WINDOW w AS (PARTITION BY predicted_route ORDER BY step))
WHERE pl IS NULL OR NOT (pl = lat AND po = lon)""", ("lat", "lon"))
SQL["geojson_anomaly_tracks"] = P_(f""",
an AS (
  SELECT c.mmsi, c.lat, c.lon, row_number() OVER (PARTITION BY c.mmsi ORDER BY ts, c.lat, c.lon) - 1 AS i
  FROM clean_points c WHERE c.mmsi IN (SELECT mmsi FROM predictions WHERE is_anomaly)
),
an_in AS (
  SELECT mmsi, i // 1000 AS piece, i, lat, lon FROM an
  UNION ALL SELECT mmsi, i // 1000 + 1, i, lat, lon FROM an WHERE i % 1000 = 999
),
an_lines AS (
  SELECT mmsi, CAST(piece AS BIGINT) AS piece, list([{rc('lon')}, {rc('lat')}] ORDER BY i) AS coordinates
  FROM an_in GROUP BY mmsi, piece HAVING count(*) >= 2
)
SELECT l.*, p.anomaly_score, p.predicted_route FROM an_lines l JOIN predictions p USING (mmsi)""", ("anomaly_score",))
_LEGS = ", ".join(f"[dead_reckoning_pred_lon_{h}h, dead_reckoning_pred_lat_{h}h]" for h in HZ)
SQL["forecast_paths"] = f"""
SELECT mmsi, list_transform(legs, lambda p: list_transform(p, lambda v: {r6('v')})) AS coordinates
FROM (
  SELECT f.mmsi, list_filter([[coalesce(start_lon, end_lon), coalesce(start_lat, end_lat)], {_LEGS}], lambda p: p[1] IS NOT NULL AND p[2] IS NOT NULL) AS legs
  FROM ({_FORECAST}) f JOIN ({P_("SELECT mmsi, end_lat, end_lon FROM predictions")}) p USING (mmsi)
) WHERE len(list_distinct(list_transform(legs, lambda p: list_transform(p, lambda v: round(v, 9))))) >= 2"""  # engines differ in the last bit
_EARLY = tuple(c for c in EARLY_BASE if c not in ("width", "length", "draught", "shiptype"))
_STATIC = ("width", "length", "draught", "shiptype")
_WIDE = [f"early_{a}_{k:02d}" for a in ("lat", "lon") for k in range(24)]
SQL["early_feature_matrix"] = rounded(
    W(CLEAN_POINTS, EARLY_POINTS, track_features_sql("early_points", "early_", static=False, observed=True), signature_sql("early_points"),
      "st AS (SELECT mmsi, " + ", ".join(f"coalesce(quantile_cont({c}, 0.5), 0.0) AS {c}" for c in _STATIC) + " FROM clean_points GROUP BY mmsi)",
      "wide AS (SELECT mmsi, " + ", ".join(
          f"max(CASE WHEN step = {int(c[-2:])} THEN {c.split('_')[1]} END) AS {c}" for c in _WIDE) + " FROM sig GROUP BY mmsi)")
    + f"\nSELECT mmsi, {', '.join((*_EARLY, *_STATIC, *_WIDE))} FROM feat JOIN st USING (mmsi) JOIN wide USING (mmsi)",
    tuple(c for c in (*_EARLY, *_STATIC, *_WIDE) if c != "early_point_count"))


# -------------------------------------------------------------- streaming --

SQL["hourly_resample_stream"] = rounded(W(RAW_POINTS, RANGED) + """
SELECT mmsi, date_trunc('hour', ts) AS ts, avg(lat) AS lat, avg(lon) AS lon, avg(sog) AS sog, avg(cog) AS cog,
  avg(width) AS width, avg(length) AS length, avg(draught) AS draught
FROM rg WHERE mmsi IS NOT NULL AND ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
GROUP BY mmsi, date_trunc('hour', ts)""", ("lat", "lon", "sog", "cog", "width", "length", "draught"))
SQL["stop_events_stream"] = rounded(W(CLEAN_POINTS, STOP_SUMMARY) + """
SELECT mmsi, start_timestamp, end_timestamp, point_count, center_lat, center_lon, mean_sog FROM stop_summary""",
                                    ("center_lat", "center_lon", "mean_sog"))
