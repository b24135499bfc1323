"""Geodesy and motion expressions.

Each function returns Spark SQL expression *text* over column names or other
expression texts (``*_sql``), and a Column wrapper (``F.expr``) around it.
Text composes into ``selectExpr`` / ``spark.sql`` and reaches the JVM in one
call, and every expression is a Catalyst built-in (no Python UDF), so it runs
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
EARTH_RADIUS_KM = 6371.0088
KNOT_KM_PER_H = 1.852


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance in km; ``sqrt(a)`` clamped to 1 so asin never NaNs."""

    return (
        f"({EARTH_RADIUS_KM * 2.0}D * asin(least(1.0D, sqrt("
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2.0D), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2.0D), 2)"
        f"))))"
    )


def bearing_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Initial bearing from point 1 to point 2 in [0, 360)."""

    x = f"(sin(radians(({lon2}) - ({lon1}))) * cos(radians({lat2})))"
    y = (
        f"(cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1})) * cos(radians({lat2}))"
        f" * cos(radians(({lon2}) - ({lon1}))))"
    )
    return f"pmod(degrees(atan2({x}, {y})) + 360.0D, 360.0D)"


def bearing_or_zero_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Bearing with null or non-finite inputs mapped to 0 (map / type-model variant)."""

    b = bearing_sql(lat1, lon1, lat2, lon2)
    return f"coalesce(nanvl({b}, CAST(NULL AS DOUBLE)), 0.0D)"


def dead_reckon_sql(lat: str, lon: str, sog: str, cog: str, hours: str) -> tuple[str, str]:
    """Great-circle destination from a start, speed over ground and course.

    Speed (knots, non-finite → 0) is clipped to [0, 70] and converted to km/h,
    course is taken mod 360 (null → 0); longitude wraps to [-180, 180).
    """

    speed = f"least(greatest(coalesce(nanvl({sog}, 0.0D), 0.0D), 0.0D), 70.0D)"
    ang = f"(({speed}) * {KNOT_KM_PER_H}D * ({hours}) / {EARTH_RADIUS_KM}D)"
    brg = f"radians(pmod(coalesce(nanvl({cog}, 0.0D), 0.0D), 360.0D))"
    p1, l1 = f"radians({lat})", f"radians({lon})"
    p2 = f"asin(sin({p1}) * cos({ang}) + cos({p1}) * sin({ang}) * cos({brg}))"
    l2 = f"({l1} + atan2(sin({brg}) * sin({ang}) * cos({p1}), cos({ang}) - sin({p1}) * sin({p2})))"
    return f"degrees({p2})", f"(pmod(degrees({l2}) + 180.0D, 360.0D) - 180.0D)"


def straightness_sql(displacement: str, path: str) -> str:
    return f"(CASE WHEN ({path}) > 0 THEN ({displacement}) / ({path}) ELSE 0.0D END)"


def valid_lonlat_sql(lon: str, lat: str) -> str:
    return (
        f"({lon} IS NOT NULL AND {lat} IS NOT NULL AND NOT isnan({lon}) AND NOT isnan({lat})"
        f" AND {lon} BETWEEN -180.0D AND 180.0D AND {lat} BETWEEN -90.0D AND 90.0D)"
    )


def trig_sql(deg: str) -> tuple[str, str]:
    """sin / cos of an angle in degrees; null angle counts as 0."""

    return f"sin(radians(coalesce({deg}, 0.0D)))", f"cos(radians(coalesce({deg}, 0.0D)))"


# Column wrappers -----------------------------------------------------------

def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    return F.expr(haversine_sql(lat1, lon1, lat2, lon2))


def bearing_degrees(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    return F.expr(bearing_sql(lat1, lon1, lat2, lon2))


def bearing_or_zero(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    return F.expr(bearing_or_zero_sql(lat1, lon1, lat2, lon2))


def dead_reckon(lat: str, lon: str, sog: str, cog: str, hours: str) -> tuple[Column, Column]:
    a, b = dead_reckon_sql(lat, lon, sog, cog, hours)
    return F.expr(a), F.expr(b)


def straightness(displacement: str, path: str) -> Column:
    return F.expr(straightness_sql(displacement, path))


def valid_lonlat(lon: str, lat: str) -> Column:
    return F.expr(valid_lonlat_sql(lon, lat))
