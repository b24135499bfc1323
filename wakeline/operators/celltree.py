"""Points on the globe as a tree of cells with circles around their points.

Points are dealt into the cells of a latitude-longitude grid, and a cell with
more points than a leaf may hold is cut into smaller ones, again and again. A
node knows its number of points, its weight and a circle: the middle of its cell
and the distance of its furthest point. By the triangle inequality two nodes'
circles bound the distances between all their points. One map-side combined
aggregate makes the cells of all levels (so no task holds a cell's points), and
those below a leaf are dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import EARTH_RADIUS_KM, haversine_sql
from wakeline.scratch import Scratch

LEAF = 32
#: Halvings of a first cell's side at each level: sixteen children at most, or
#: sixty-four in the first two steps down from the globe.
FINE = tuple(range(0, 25, 2))
GLOBE = (0, 3, 6, *range(8, 25, 2))
SLACK_KM = 1e-7  # what rounding may do to a distance, by far


def grid_cell_sql(lat: str, lon: str, eps_km: float) -> tuple[str, str, str, float]:
    """(band, cells in the band, cell, side in degrees) of a grid whose cells
    have a diagonal of less than ``eps_km``: sides of at most 0.7 of it."""

    side = 0.7 * math.degrees(eps_km / EARTH_RADIUS_KM)
    bands = int(math.ceil(180.0 / side))
    band = f"least(CAST(floor(({lat} + 90.0D) / {side!r}D) AS INT), {bands - 1})"
    low = f"least(abs({band} * {side!r}D - 90.0D), abs(({band} + 1) * {side!r}D - 90.0D))"  # nearest the equator
    near = f"IF({band} * {side!r}D <= 90.0D AND ({band} + 1) * {side!r}D >= 90.0D, 0.0D, {low})"
    cells = f"greatest(1, CAST(ceil(360.0D * cos(radians({near})) / {side!r}D) AS INT))"
    return band, cells, f"pmod(CAST(floor(({lon} + 180.0D) / 360.0D * {cells}) AS INT), {cells})", side


class CellTree:
    """``nodes`` of all levels (node, n, w, r, lat, lon, parent, open: has it
    children) and the leaves' ``points`` (node, pid, lat, lon, w). The cells of
    the first level have a diagonal below ``eps_km``; a leaf holds ``leaf`` points
    at most, unless they lie in one cell of the last level. ``points``: pid, lat,
    lon, w, of valid coordinates, no two at one place."""

    def __init__(self, scratch: Scratch, points: DataFrame, eps_km: float, leaf: int = LEAF, levels: tuple[int, ...] = FINE):
        self.levels = levels
        band, cells, cell, side = grid_cell_sql("lat", "lon", eps_km)
        last = levels[-1]
        top = 1 << last
        base = points.selectExpr("pid", "lat", "lon", "w", f"{band} AS b", f"{cells} AS k", f"{cell} AS c").selectExpr(
            "*", f"CAST(least(greatest(floor(((lat + 90.0D) / {side!r}D - b) * {top}), 0), {top - 1}) AS BIGINT) AS iy",
            f"CAST(least(floor(((lon + 180.0D) / 360.0D * k - floor((lon + 180.0D) / 360.0D * k)) * {top}), {top - 1}) AS BIGINT) AS ix")
        base = scratch.write(base, "points")

        def node(level: int) -> str:
            return f"named_struct('l', {level}, 'b', b, 'c', c, 'y', shiftright(iy, {last - level}), 'x', shiftright(ix, {last - level}))"

        def place(level: int) -> str:
            parts = float(1 << level)
            mid_lat = f"least(90.0D, (b + (shiftright(iy, {last - level}) + 0.5D) / {parts}D) * {side!r}D - 90.0D)"
            return f"{mid_lat}, 'mlon', (c + (shiftright(ix, {last - level}) + 0.5D) / {parts}D) * 360.0D / k - 180.0D"

        none = "CAST(NULL AS STRUCT<l: INT, b: INT, c: INT, y: BIGINT, x: BIGINT>)"
        each = ", ".join(
            f"named_struct('node', {node(level)}, 'parent', {node(up) if up is not None else none}, 'mlat', {place(level)})"
            for up, level in zip((None, *levels), levels, strict=False))
        cells_ = base.selectExpr("lat", "lon", "w", f"inline(array({each}))").groupBy("node").agg(
            F.expr("count(1) AS n"), F.expr("sum(w) AS w"), F.expr(f"max({haversine_sql('lat', 'lon', 'mlat', 'mlon')}) AS r"),
            F.expr("min(mlat) AS lat"), F.expr("min(mlon) AS lon"), F.expr("first(parent) AS parent"))
        cells_ = scratch.write(cells_, "cells")
        full = cells_.where(f"n > {leaf}").selectExpr("node AS parent")
        kept = cells_.join(full, "parent", "left_semi").unionByName(cells_.where("parent IS NULL"))
        self.nodes = scratch.write(kept.selectExpr("node", "n", "w", "r", "lat", "lon", "parent", f"n > {leaf} AND node.l < {last} AS open"), "tree")
        ends = self.nodes.where("NOT open").select("node")
        self.points = scratch.write(base.selectExpr("pid", "lat", "lon", "w", f"explode(array({', '.join(node(v) for v in levels)})) AS node").join(
            ends, "node").select("node", "pid", "lat", "lon", "w"), "leaves")

    def ancestors(self, node: str) -> str:
        """``node`` and the nodes above it, as an array."""

        return (
            f"transform(filter(array({', '.join(map(str, self.levels))}), j -> j <= {node}.l), j -> named_struct('l', j, 'b', {node}.b, 'c', {node}.c,"
            f" 'y', shiftright({node}.y, {node}.l - j), 'x', shiftright({node}.x, {node}.l - j)))")

    def kids(self) -> DataFrame:
        """(parent, kids): the children of every node that has some, sixty-four at most."""

        return self.nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.collect_list("node").alias("kids"))

    def packed(self) -> DataFrame:
        """(node, p): the points of every leaf."""

        return self.points.groupBy("node").agg(F.collect_list(F.struct("pid", "lat", "lon", "w")).alias("p"))


def split(pairs: DataFrame, side: str, kids: DataFrame) -> DataFrame:
    """``pairs`` with column ``side`` replaced by each of its children; nodes
    without any stay."""

    found = kids.select(F.col("parent").alias(side), F.col("kids").alias("_k"))
    rest = [c for c in pairs.columns if c != side]
    return pairs.join(found, side, "left").selectExpr(*rest, f"explode(coalesce(_k, array({side}))) AS {side}")
