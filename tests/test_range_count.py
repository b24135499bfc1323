"""Range counts over a cell tree against all pairs."""

import math
import random

import pytest

from wakeline.functions.geo import EARTH_RADIUS_KM
from wakeline.operators.celltree import CellTree
from wakeline.operators.range_count import _settle, range_counts
from wakeline.scratch import Scratch

SCHEMA = "pid long, lat double, lon double, w long"


def hav(a, b):
    p1, p2 = math.radians(a[1]), math.radians(b[1])
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return EARTH_RADIUS_KM * 2 * math.asin(min(1.0, math.sqrt(x)))


def points(places, rng):
    return [(i, la, lo - 360 if lo > 180 else lo, rng.randint(1, 4)) for i, (la, lo) in enumerate(dict.fromkeys(places))]


def check(spark, rows, eps=2.0, leaf=32):
    got = {r.pid: r.n for r in range_counts(spark.createDataFrame(rows, SCHEMA), eps, leaf).collect()}
    assert got == {a[0]: sum(b[3] for b in rows if hav(a, b) <= eps) for a in rows}


@pytest.mark.parametrize("leaf", [4])
def test_port_chain_date_line_and_pole(spark, leaf):
    rng = random.Random(1)
    places = [(rng.gauss(54, 0.008), rng.gauss(8, 0.012)) for _ in range(250)]
    places += [(10 + 0.0099 * i, 179.95 + 0.009 * i) for i in range(60)]
    places += [(89.99 + rng.uniform(0, 0.01), rng.uniform(-180, 180)) for _ in range(25)] + [(90.0, 0.0), (-90.0, 5.0), (0.0, 180.0), (0.0, -180.0)]
    places += [(rng.uniform(40, 40.3), rng.uniform(3, 3.3)) for _ in range(60)]
    check(spark, points(places, rng), leaf=leaf)


def test_points_at_the_radius_and_close_together(spark):
    rng = random.Random(2)
    step = math.degrees(2.0 / EARTH_RADIUS_KM)
    places = [(i * step, 0.0) for i in range(6)] + [(1e-9 * i, 5.0) for i in range(20)] + [(step + 1e-9 * i, 5.0) for i in range(20)]
    check(spark, points(places, rng), leaf=8)
    check(spark, points([(54.0, 8.0)], rng))
    assert range_counts(spark.createDataFrame([], SCHEMA), 2.0).count() == 0


def test_a_dense_port_compares_few_points(spark):
    """Four times the points in one port: far from sixteen times the work."""

    rng, work = random.Random(3), []
    for n in (300, 1200):
        rows = points([(rng.gauss(54, 0.01), rng.gauss(8, 0.015)) for _ in range(n)], rng)
        scratch = Scratch(spark, "test")
        tree = CellTree(scratch, spark.createDataFrame(rows, SCHEMA), 2.0, 8)
        _, open_ = _settle(scratch, tree, 2.0)
        size = tree.nodes.select("node", "n")
        pairs = open_.join(size.withColumnRenamed("node", "a").withColumnRenamed("n", "na"), "a").join(size.withColumnRenamed("node", "b"), "b")
        work.append(pairs.selectExpr("sum(na * n)").first()[0])
    assert work[1] < 10 * work[0] and work[1] < 1200 * 1200 / 2, work
