"""Joins against brute force: nearest as-of, nearest centre, range pairs."""

import datetime as dt
import math
import random

from wakeline.functions.geo import EARTH_RADIUS_KM
from wakeline.operators.joins import future_targets, grid_pairs, nearest_centre


def hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
    return EARTH_RADIUS_KM * 2 * math.asin(min(1.0, math.sqrt(x)))


def test_asof_nearest_ties_and_tolerance(spark):
    t0 = dt.datetime(2024, 1, 1)
    mins = [0, 30, 60, 90, 95, 150, 151, 240, 330]
    rows = [(1, i, t0 + dt.timedelta(minutes=m), float(i), 0.0) for i, m in enumerate(mins)]
    df = spark.createDataFrame(rows, "mmsi long, rid long, ts timestamp, lat double, lon double")
    got = {r.rid: r.target_lat_1h for r in future_targets(df, [1], 45).collect()}
    for i, m in enumerate(mins):
        cands = [(abs((mm - 60) - m), 0 if mm - 60 <= m else 1, j) for j, mm in enumerate(mins) if abs(mm - 60 - m) <= 45]
        if not cands:
            assert i not in got
            continue
        best = min(cands, key=lambda c: (c[0], c[1]))
        assert got[i] == float(best[2])


def test_nearest_centre_and_pairs(spark):
    rng = random.Random(3)
    pts = [(i, rng.uniform(-60, 60), rng.uniform(-179, 179)) for i in range(60)]
    cen = [(f"c{j}", j, rng.uniform(-60, 60), rng.uniform(-179, 179)) for j in range(7)]
    p = spark.createDataFrame(pts, "mmsi long, end_lat double, end_lon double")
    c = spark.createDataFrame(cen, "anchorage_id string, rank int, center_lat double, center_lon double")
    got = {r.mmsi: r.anchorage_id for r in nearest_centre(p, c).collect()}
    for i, la, lo in pts:
        best = min(cen, key=lambda x: (hav(la, lo, x[2], x[3]), x[1]))
        assert got[i] == best[0]
    near = [(i, 10.0 + rng.uniform(0, 0.05), 179.98 + rng.uniform(-0.03, 0.03)) for i in range(40)]
    near = [(i, la, lo - 360 if lo > 180 else lo) for i, la, lo in near]
    q = spark.createDataFrame(near, "pid long, lat double, lon double")
    got = {(r.a, r.b) for r in grid_pairs(q, 2.0).collect()}
    want = {(a[0], b[0]) for a in near for b in near if hav(a[1], a[2], b[1], b[2]) <= 2.0}
    assert got == want
