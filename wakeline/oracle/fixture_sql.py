"""DuckDB text of the fixture mapping (the SQL twin of ``sources.fixtures``).

Used only to build the independent SQL oracles in ``__spark_entry__``.
"""

from __future__ import annotations

RAW_POINTS = """
raw_ev AS (
  SELECT event_id, user_id, event_type, value,
         1704067200 + (epoch_us(ts) - 1704067200000000) // 8000000 AS t
  FROM events
),
raw_span AS (SELECT user_id, min(t) AS t0, max(t) AS t1 FROM raw_ev GROUP BY user_id),
raw_p AS (
  SELECT e.*, user_id % 6 AS lane,
         ((t - t0) * 1000) // greatest(t1 - t0, 1) AS prog
  FROM raw_ev e JOIN raw_span USING (user_id)
),
raw_q AS (SELECT *, greatest(0, least(700, prog - 150)) AS qq FROM raw_p),
raw_points AS (
  SELECT
    event_id AS rid,
    CAST(CASE WHEN event_id % 89 = 0 THEN 0 ELSE 219000000 + user_id END AS BIGINT) AS mmsi,
    make_timestamp(t * 1000000) AS ts,
    CASE WHEN event_id % 97 = 0 THEN 91.0
         ELSE CAST(54000000 + lane * 600000 + qq * (lane % 3 - 1) * 1200 + (event_id * 7919) % 2001 - 1000 AS DOUBLE) / 1000000
    END AS lat,
    CAST(8000000 + lane * 900000 + qq * (CASE WHEN lane % 2 = 0 THEN 3000 ELSE -2500 END)
         + (event_id * 104729) % 2001 - 1000 AS DOUBLE) / 1000000 AS lon,
    CAST(CASE WHEN event_id % 83 = 0 THEN NULL
              WHEN prog < 150 OR prog > 850 THEN (event_id % 10) / 10
              ELSE value / 4 END AS DOUBLE) AS sog,
    CAST(((event_id * 37) % 3600) / 10 AS DOUBLE) AS cog,
    CAST(((event_id * 37) % 3600) / 10 + (event_id % 7) - 3 AS DOUBLE) AS heading_raw,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE 10.0 + (user_id % 4) * 6.0 END AS width,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE 40.0 + (user_id % 4) * 45.0 END AS length,
    CASE WHEN event_id % 5 = 0 OR user_id % 7 = 0 THEN NULL ELSE (30 + (user_id % 4) * 25) / 10 END AS draught,
    CASE user_id % 4 WHEN 0 THEN 'Cargo' WHEN 1 THEN 'Tanker' WHEN 2 THEN 'Passenger' ELSE 'Fishing' END AS shiptype,
    CASE event_type WHEN 'view' THEN 'Under way using engine' WHEN 'click' THEN 'Under way using engine'
         WHEN 'purchase' THEN 'At anchor' WHEN 'error' THEN 'Moored' WHEN 'signup' THEN 'Engaged in fishing'
         ELSE 'Unknown' END AS navigationalstatus,
    CASE WHEN event_id % 13 = 0 THEN NULL
         ELSE 'lane_' || CAST((lane + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) % 6 AS VARCHAR) END AS route_label
  FROM raw_q
),
points_base AS (
  SELECT rid, mmsi, ts, lat, lon, sog, cog,
         heading_raw - 360.0 * floor(heading_raw / 360.0) AS heading,
         CAST(width AS DOUBLE) AS width, CAST(length AS DOUBLE) AS length, CAST(draught AS DOUBLE) AS draught,
         shiptype, navigationalstatus, route_label
  FROM raw_points
),
points_src AS (
  SELECT * FROM points_base
  UNION ALL
  SELECT rid + 1000000000000 AS rid, mmsi, ts, lat, lon, sog + 0.5 AS sog, cog, heading, width, length, draught,
         shiptype, navigationalstatus, route_label
  FROM points_base WHERE rid % 101 = 0
  UNION ALL
  SELECT rid + 2000000000000 AS rid, mmsi, ts, lat, lon + 0.002 AS lon, sog, cog, heading, width, length, draught,
         shiptype, navigationalstatus, route_label
  FROM points_base WHERE rid % 103 = 0
)"""

# Cleaned route-path points (clean_points) in SQL.
CLEAN_POINTS = RAW_POINTS + """,
c_range AS (
  SELECT rid,
    CASE WHEN mmsi BETWEEN 100000000 AND 999999998 THEN mmsi END AS mmsi, ts,
    CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS lat,
    CASE WHEN lon BETWEEN -180 AND 180 THEN lon END AS lon,
    CASE WHEN sog BETWEEN 0 AND 70 THEN sog END AS sog,
    CASE WHEN cog BETWEEN 0 AND 360 THEN cog END AS cog,
    CASE WHEN width >= 0 THEN width END AS width,
    CASE WHEN length >= 0 THEN length END AS length,
    CASE WHEN draught >= 0 THEN draught END AS draught,
    TRY_CAST(shiptype AS DOUBLE) AS shiptype,
    route_label
  FROM points_src
),
c_keys AS (SELECT * FROM c_range WHERE mmsi IS NOT NULL AND ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL),
c_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY mmsi, ts, lat, lon ORDER BY rid) AS rn FROM c_keys
  ) WHERE rn = 1
),
c_stack AS (
  SELECT mmsi, 'width' AS name, width AS value FROM c_dedup UNION ALL
  SELECT mmsi, 'length', length FROM c_dedup UNION ALL
  SELECT mmsi, 'draught', draught FROM c_dedup UNION ALL
  SELECT mmsi, 'shiptype', shiptype FROM c_dedup
),
c_kmed AS (SELECT mmsi, name, quantile_cont(value, 0.5) AS kmed FROM c_stack WHERE value IS NOT NULL GROUP BY mmsi, name),
c_filled AS (
  SELECT s.name, coalesce(s.value, k.kmed) AS value
  FROM c_stack s LEFT JOIN c_kmed k USING (mmsi, name)
),
c_gmed AS (SELECT name, quantile_cont(value, 0.5) AS gmed FROM c_filled WHERE value IS NOT NULL GROUP BY name),
clean_points AS (
  SELECT d.rid, d.mmsi, d.ts, d.lat, d.lon,
    coalesce(d.sog, 0.0) AS sog, coalesce(d.cog, 0.0) AS cog,
    coalesce(d.width, kw.kmed, gw.gmed, 0.0) AS width,
    coalesce(d.length, kl.kmed, gl.gmed, 0.0) AS length,
    coalesce(d.draught, kd.kmed, gd.gmed, 0.0) AS draught,
    coalesce(d.shiptype, ks.kmed, gs.gmed, 0.0) AS shiptype,
    d.route_label
  FROM c_dedup d
  LEFT JOIN c_kmed kw ON kw.mmsi = d.mmsi AND kw.name = 'width'
  LEFT JOIN c_kmed kl ON kl.mmsi = d.mmsi AND kl.name = 'length'
  LEFT JOIN c_kmed kd ON kd.mmsi = d.mmsi AND kd.name = 'draught'
  LEFT JOIN c_kmed ks ON ks.mmsi = d.mmsi AND ks.name = 'shiptype'
  LEFT JOIN c_gmed gw ON gw.name = 'width'
  LEFT JOIN c_gmed gl ON gl.name = 'length'
  LEFT JOIN c_gmed gd ON gd.name = 'draught'
  LEFT JOIN c_gmed gs ON gs.name = 'shiptype'
)"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(6371.0088 * 2.0 * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2.0), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2.0), 2)))))"
    )


def bearing(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    x = f"(sin(radians({lon2} - {lon1})) * cos(radians({lat2})))"
    y = (
        f"(cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1})) * cos(radians({lat2}))"
        f" * cos(radians({lon2} - {lon1})))"
    )
    d = f"(degrees(atan2({x}, {y})) + 360.0)"
    return f"({d} - 360.0 * floor({d} / 360.0))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().lstrip(",") for c in ctes)
