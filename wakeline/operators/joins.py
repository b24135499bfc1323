"""Joins Spark has no operator for, as DataFrame plans with bounded blow-up.

* ``future_targets``: nearest as-of join with tolerance (per vessel, per
  horizon) as windows over points and shifted targets in time buckets.
* ``nearest_centre``: nearest-neighbour join of points to a centre table by
  branch and bound over two cell trees (no cross join).
* ``grid_pairs``: fixed-radius self join on a latitude-band / longitude-cell
  grid (inside DBSCAN).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import EARTH_RADIUS_KM, haversine_sql
from wakeline.operators.celltree import GLOBE, LEAF, SLACK_KM, CellTree, split
from wakeline.operators.sequence import DEFAULT_BUCKET_SECONDS
from wakeline.scratch import Scratch

# Fixed values of the reference.
HORIZONS_H = (1, 2, 3)
TOLERANCE_MIN = 45


def future_targets(
    points: DataFrame,
    horizons: Sequence[int] = HORIZONS_H,
    tolerance_minutes: int = TOLERANCE_MIN,
    key: str = "mmsi",
    row_id: str = "rid",
) -> DataFrame:
    """Attach, for every point and horizon h, the point of the same vessel
    whose time minus h is nearest to the point's time, within the tolerance.

    Rules (pandas ``merge_asof(direction="nearest")``): an exact or earlier
    candidate wins a tie; of several targets at the same time the backward
    pick is the last and the forward pick the first (order lat, lon, row id);
    the tolerance is inclusive. Rows lacking any target are dropped, and so
    are vessels with fewer than ``max(h) + 1`` points.

    Plan: a point is sent once to its own time bucket of the vessel, and as a
    target to each bucket where a point could ask for it within the tolerance
    (mostly the same one). There it becomes a row for every horizon it asks for
    (side 1) and for every horizon it answers (side 0, time shifted by -h), and
    a window carries the last target forward and the next one backward; the
    nearer one is kept. Linear in rows, one shuffle of the points for the
    windows and one to pivot horizons back to columns; no pair is ever formed.
    """

    hs = sorted({int(h) for h in horizons if int(h) > 0})
    if not hs:
        raise ValueError("horizons must contain a positive integer")
    tol_us = int(tolerance_minutes) * 60 * 1000000
    size = DEFAULT_BUCKET_SECONDS * 1000000
    hour = 3600 * 1000000

    def bucket(us: str) -> str:
        return f"({us} - pmod({us}, {size}L)) div {size}L"

    us = "unix_micros(ts)"
    low, high = bucket(f"({us} - {max(hs) * hour + tol_us}L)"), bucket(f"({us} - {min(hs) * hour - tol_us}L)")
    # with a number given, partitions are not put together by their size before the rows are multiplied
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = points.selectExpr(key, f"{row_id} AS _rid", "ts", "lat", "lon").where("ts IS NOT NULL").selectExpr(
        "*", f"explode(array_union(array({bucket(us)}), sequence({low}, {high}))) AS _b").repartition(parts, key, "_b")
    asks, answers = f"_b = {bucket(us)}", f"_b BETWEEN {low} AND {high}"
    u = sent.selectExpr(
        key, "_rid", "ts", "lat AS _lat", "lon AS _lon", "_b", f"explode(array({', '.join(map(str, hs))})) AS _h",
        f"filter(array(IF({asks}, 1, NULL), IF({answers}, 0, NULL)), x -> x IS NOT NULL) AS _sides").selectExpr(
        "*", "explode(_sides) AS _side").selectExpr(
        key, "_rid", "_lat", "_lon", "_b", "_h", "_side", "IF(_side = 1, ts, ts - make_dt_interval(0, _h, 0, 0)) AS _kt").selectExpr(
        "*", "IF(_side = 0, named_struct('kt', _kt, 'lat', _lat, 'lon', _lon), NULL) AS _tgt")
    w = f"PARTITION BY `{key}`, _b, _h ORDER BY"
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    order = ("_kt", "_side", "_lat", "_lon", "_rid")
    s = u.selectExpr(
        "*", f"last(_tgt, true) OVER ({w} {', '.join(order)} {upto}) AS _back",
        f"last(_tgt, true) OVER ({w} {', '.join(f'{c} DESC' for c in order)} {upto}) AS _ahead").where("_side = 1")
    db, df_ = "(unix_micros(_kt) - unix_micros(_back.kt))", "(unix_micros(_ahead.kt) - unix_micros(_kt))"
    pick = (
        f"CASE WHEN _back IS NOT NULL AND {db} <= {tol_us} AND (_ahead IS NULL OR {df_} > {tol_us} OR {db} <= {df_})"
        f" THEN _back WHEN _ahead IS NOT NULL AND {df_} <= {tol_us} THEN _ahead END"
    )
    chosen = s.selectExpr(key, "_rid", "_h", f"{pick} AS _t").where("_t IS NOT NULL").selectExpr(
        key, "_rid", "_h", "named_struct('ts', _t.kt + make_dt_interval(0, _h, 0, 0), 'lat', _t.lat, 'lon', _t.lon) AS _t")
    cols = []
    for h in hs:
        cols += [
            F.expr(f"max(CASE WHEN _h = {h} THEN _t.ts END) AS target_timestamp_{h}h"),
            F.expr(f"max(CASE WHEN _h = {h} THEN _t.lat END) AS target_lat_{h}h"),
            F.expr(f"max(CASE WHEN _h = {h} THEN _t.lon END) AS target_lon_{h}h"),
        ]
    need = " AND ".join(f"target_lat_{h}h IS NOT NULL" for h in hs)
    sizes = points.groupBy(key).agg(F.expr("count(1) AS _npts")).where(f"_npts >= {max(hs) + 1}")
    wide = chosen.groupBy(key, "_rid").agg(*cols).where(need).join(sizes, key, "left_semi")
    return points.join(wide.withColumnRenamed("_rid", row_id), [key, row_id])


# ------------------------------------------------------------ nearest --

def nearest_centre(
    points: DataFrame,
    centres: DataFrame,
    *,
    key: str = "mmsi",
    lat: str = "end_lat",
    lon: str = "end_lon",
    centre_id: str = "anchorage_id",
    centre_rank: str = "rank",
    leaf: int = LEAF,
) -> DataFrame:
    """Nearest centre for every point (first in ``centre_rank`` on a tie), by
    branch and bound over two cell trees.

    Points and centres each form a tree of cells with circles around their points.
    Beginning at the roots, a cell of points holds the cells of centres that may
    have the nearest one of any of its points: those whose least distance is not
    above the smallest greatest distance known for it. Each round cuts both sides
    into their children; a cell far away from all centres thus meets a few large
    cells, whatever their number of centres. Points are compared with centres only
    in the pairs of leaves that are left. Points at one place, and centres at one
    place (the first in rank stands for them), count once.

    Returns key, centre_id, centre_lat, centre_lon, distance_km: a row for every
    point, null where it has no valid position or no centre has one.
    """

    scratch = Scratch(points.sparkSession, "nearest")
    sound = "lat BETWEEN -90.0D AND 90.0D AND lon BETWEEN -180.0D AND 180.0D"
    asked = points.selectExpr(key, f"CAST({lat} AS DOUBLE) AS lat", f"CAST({lon} AS DOUBLE) AS lon")
    places = asked.where(sound).groupBy("lat", "lon").agg(F.expr("count(1) AS w")).selectExpr("named_struct('lat', lat, 'lon', lon) AS pid", "lat", "lon", "w")
    known = centres.selectExpr(f"{centre_id} AS id", f"{centre_rank} AS rank", "CAST(center_lat AS DOUBLE) AS lat", "CAST(center_lon AS DOUBLE) AS lon").where(sound)
    first = known.groupBy("lat", "lon").agg(F.expr("min_by(struct(rank, id), struct(rank, id)) AS pid")).selectExpr("pid", "lat", "lon", "1L AS w")
    globe = math.pi * EARTH_RADIUS_KM / 0.7  # two cells, the hemispheres
    a_tree, b_tree = (CellTree(scratch, t, globe, leaf, GLOBE) for t in (places, first))
    a, b = (t.nodes.selectExpr(f"node AS {s}", f"lat AS lat_{s}", f"lon AS lon_{s}", f"r AS r_{s}", f"open AS open_{s}") for t, s in ((a_tree, "a"), (b_tree, "b")))
    kids_a, kids_b = a_tree.kids(), b_tree.kids()
    pairs = a.where("a.l = 0").select("a", F.lit(1e300).alias("most")).crossJoin(b.where("b.l = 0").select("b"))  # two by two at most
    leaves = []
    while True:
        d = haversine_sql("lat_a", "lon_a", "lat_b", "lon_b")
        judged = pairs.join(a, "a").join(b, "b").selectExpr("a", "b", "most", "open_a", "open_b", f"{d} AS d", "r_a + r_b AS r")
        bound = judged.groupBy("a").agg(F.expr(f"min(least(most, d + r)) + {SLACK_KM!r}D AS bound"))
        kept = scratch.write(judged.join(bound, "a").where("d - r <= bound").selectExpr("a", "b", "bound AS most", "open_a OR open_b AS open"), "pairs")
        leaves.append(kept.where("NOT open").select("a", "b"))
        rest = kept.where("open").select("a", "b", "most")
        if rest.isEmpty():
            break
        pairs = split(split(rest, "a", kids_a), "b", kids_b)
    last = leaves[0]
    for more in leaves[1:]:
        last = last.unionByName(more)
    compared = last.join(a_tree.packed().selectExpr("node AS a", "p AS pa"), "a").join(b_tree.packed().selectExpr("node AS b", "p AS pb"), "b")
    each = compared.selectExpr("pb", "inline(pa) AS (pid, lat, lon, w)").selectExpr("pid", "lat", "lon", "inline(pb) AS (c, clat, clon, cw)")
    best = each.selectExpr("pid", "c", "clat", "clon", f"{haversine_sql('lat', 'lon', 'clat', 'clon')} AS d").groupBy("pid").agg(
        F.expr("min_by(struct(c.id AS id, clat, clon, d), struct(d, c.rank)) AS n")).selectExpr("pid.lat AS lat", "pid.lon AS lon", "n")
    return asked.join(best, ["lat", "lon"], "left").selectExpr(
        key, f"n.id AS {centre_id}", "n.clat AS centre_lat", "n.clon AS centre_lon", "n.d AS distance_km")


# --------------------------------------------------------- range pairs --

def grid_pairs(
    pts: DataFrame,
    eps_km: float,
    *,
    pid: str = "pid",
    lat: str = "lat",
    lon: str = "lon",
    left: DataFrame | None = None,
) -> DataFrame:
    """All pairs (a, b) with haversine(a, b) <= eps_km, self pairs included;
    ``a`` runs over ``left`` (by default all of ``pts``), ``b`` over ``pts``.

    Latitude bands of height eps; each band has its own longitude cell width,
    wide enough for any pair within eps at the band's extreme latitude (and
    its neighbours'). Side B stays in its own (band, cell); side A is exploded
    into bands b-1..b+1 and, in each, into the cells of *that* band that its
    reach touches (wrapping at +-180). Equi-join on (band, cell) + exact
    distance filter. Blow-up per point is at most 3 bands x 3 cells.
    """

    eps_deg = math.degrees(eps_km / EARTH_RADIUS_KM)
    n_bands = int(math.ceil(180.0 / eps_deg))

    def width_sql(band: str) -> str:
        # largest |lat| over the band and its neighbours
        edge = f"greatest(abs(({band} - 1) * {eps_deg}D - 90.0D), abs(({band} + 2) * {eps_deg}D - 90.0D))"
        ratio = f"sin(radians({eps_deg}D) / 2.0D) / cos(radians(least({edge}, 89.999D)))"
        wmin = (
            f"CASE WHEN {edge} >= 89.0D OR {ratio} >= 0.5D THEN 360.0D "
            f"ELSE least(360.0D, 2.0D * degrees(asin({ratio})) * 1.0001D) END"
        )
        # an integer number of equal cells per band, so wrapping at +-180 is exact
        return f"(360.0D / greatest(1, CAST(floor(360.0D / ({wmin})) AS INT)))"

    band = f"least(CAST(floor(({lat} + 90.0D) / {eps_deg}D) AS INT), {n_bands - 1})"
    b = pts.selectExpr(pid, lat, lon, f"{band} AS _band").selectExpr(
        "*", f"{width_sql('_band')} AS _w"
    ).selectExpr(
        f"{pid} AS _pid_b", f"{lat} AS _lat_b", f"{lon} AS _lon_b", "_band",
        f"pmod(CAST(floor(({lon} + 180.0D) / _w) AS INT), CAST(round(360.0D / _w) AS INT)) AS _cell",
    )
    a = (pts if left is None else left).selectExpr(pid, lat, lon, f"{band} AS _band0").selectExpr(
        "*", "explode(array(_band0 - 1, _band0, _band0 + 1)) AS _band"
    ).where(f"_band >= 0 AND _band < {n_bands}").selectExpr("*", f"{width_sql('_band')} AS _w").selectExpr(
        "*",
        "CAST(round(360.0D / _w) AS INT) AS _ncell",
        f"CAST(floor(({lon} + 180.0D) / _w) AS INT) AS _c0",
    ).selectExpr(
        f"{pid} AS _pid_a", f"{lat} AS _lat_a", f"{lon} AS _lon_a", "_band",
        "explode(array_distinct(array(pmod(_c0 - 1, _ncell), _c0 % _ncell, pmod(_c0 + 1, _ncell)))) AS _cell",
    )
    j = a.join(b, ["_band", "_cell"])
    d = haversine_sql("_lat_a", "_lon_a", "_lat_b", "_lon_b")
    return j.where(f"{d} <= {float(eps_km)}D").selectExpr("_pid_a AS a", "_pid_b AS b")
