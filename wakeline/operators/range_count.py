"""How many points lie within a radius of each point, without forming the pairs.

The points form a cell tree (``celltree.py``) whose nodes know their weight and a
circle around their points. Two nodes whose circles lie
wholly within the radius of each other add the weight of one to all points of the
other at once; two wholly apart are dropped; only for the others are the
children looked at, and only between leaves at the border are points compared.
For n points spread evenly over one radius that is about n^1.5 steps at worst,
where all pairs are n^2; points in tight groups settle near the top.

Each round over pairs is a written table; everything is an equi-join on node ids. Points at one place are merged first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import haversine_sql
from wakeline.operators.celltree import LEAF, SLACK_KM, CellTree, split
from wakeline.operators.joins import grid_pairs
from wakeline.scratch import Scratch

def _settle(scratch: Scratch, tree: CellTree, eps_km: float) -> tuple[DataFrame, DataFrame]:
    """(adds, open): the weight that every node gets as a whole (a, w), and the
    pairs of leaves (a, b) whose points have to be compared."""

    nodes = tree.nodes.select("node", "w", "r", "lat", "lon", "open")
    kids = tree.kids()
    pairs = grid_pairs(nodes.where("node.l = 0"), 2.0 * eps_km, pid="node")
    adds, leaves = [], []
    a, b = (nodes.select(*[F.col(c).alias(f"{c}_{s}") for c in nodes.columns]) for s in "ab")
    apart = haversine_sql("lat_a", "lon_a", "lat_b", "lon_b")
    while True:
        judged = pairs.join(a, pairs["a"] == a["node_a"]).join(b, F.col("b") == F.col("node_b")).selectExpr(
            "a", "b", "w_b AS w", "open_a", "open_b", f"{apart} AS d", "r_a + r_b AS reach").selectExpr(
            "a", "b", "w", "open_a", "open_b", f"d + reach <= {eps_km - SLACK_KM!r}D AS inside").where(f"d - reach <= {eps_km + SLACK_KM!r}D")
        judged = scratch.write(judged, "pairs")
        adds.append(judged.where("inside").groupBy("a").agg(F.sum("w").alias("w")))
        leaves.append(judged.where("NOT inside AND NOT open_a AND NOT open_b").select("a", "b"))
        rest = judged.where("NOT inside AND (open_a OR open_b)").select("a", "b")
        if rest.isEmpty():
            break
        pairs = split(split(rest, "a", kids), "b", kids)
    every, open_ = adds[0], leaves[0]
    for x, y in zip(adds[1:], leaves[1:], strict=True):
        every, open_ = every.unionByName(x), open_.unionByName(y)
    return every.groupBy("a").agg(F.sum("w").alias("w")), open_


def range_counts(points: DataFrame, eps_km: float, leaf: int = LEAF) -> DataFrame:
    """(pid, n): for each of ``points`` (pid, lat, lon, w) the weight of all
    points within ``eps_km``, itself included. ``pid`` is any one type, no two
    points share a place, and coordinates are valid."""

    scratch = Scratch(points.sparkSession, "range-count")
    tree = CellTree(scratch, points, eps_km, leaf)
    adds, open_ = _settle(scratch, tree, eps_km)
    whole = tree.nodes.where("NOT open").selectExpr("node", f"explode({tree.ancestors('node')}) AS a").join(adds, "a").groupBy("node").agg(F.sum("w").alias("n"))
    packed = tree.packed()
    compared = open_.join(packed.selectExpr("node AS a", "p AS pa"), "a").join(packed.selectExpr("node AS b", "p AS pb"), "b")
    near = compared.selectExpr("pb", "inline(pa) AS (pid, lat, lon, wa)").selectExpr("pid", "lat", "lon", "inline(pb) AS (pid_b, lat_b, lon_b, w)").where(
        f"{haversine_sql('lat', 'lon', 'lat_b', 'lon_b')} <= {float(eps_km)!r}D").groupBy("pid").agg(F.sum("w").alias("n"))
    return tree.points.select("node", "pid").join(whole, "node", "left").select("pid", "n").unionByName(near).groupBy("pid").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
