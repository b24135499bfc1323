"""The nearest-centre join against all distances."""

import random

import numpy as np

from wakeline.functions.geo import EARTH_RADIUS_KM
from wakeline.operators.joins import nearest_centre

POINTS, CENTRES = "mmsi long, end_lat double, end_lon double, lat string", "anchorage_id string, rank int, center_lat double, center_lon double"


def brute(points, centres):
    c = np.radians(np.array([[x[2], x[3]] for x in centres]))
    out = {}
    for m, la, lo, _ in points:
        p = np.radians([la, lo])
        h = np.sin((c[:, 0] - p[0]) / 2) ** 2 + np.cos(p[0]) * np.cos(c[:, 0]) * np.sin((c[:, 1] - p[1]) / 2) ** 2
        d = EARTH_RADIUS_KM * 2 * np.arcsin(np.minimum(1.0, np.sqrt(h)))
        out[m] = min((round(float(d[i]), 9), centres[i][1], centres[i][0]) for i in np.flatnonzero(d <= d.min() + 1e-6))
    return out


def run(spark, points, centres, **kw):
    got = nearest_centre(spark.createDataFrame(points, POINTS), spark.createDataFrame(centres, CENTRES), **kw).collect()
    assert len(got) == len(points)
    return {r.mmsi: r for r in got}


def test_ten_thousand_centres(spark):
    rng = random.Random(1)
    centres = [(rng.gauss(54, 1), rng.gauss(8, 2)) for _ in range(6000)] + [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(3000)]
    centres += [(rng.gauss(0, 0.3), 179.9 + rng.uniform(0, 0.2)) for _ in range(998)] + [(90.0, 0.0), (-90.0, 17.0)]
    centres = [(f"c{i}", i, la, lo - 360 if lo > 180 else lo) for i, (la, lo) in enumerate(centres)]
    rng.shuffle(centres)
    points = [(rng.gauss(54, 2), rng.gauss(8, 3)) for _ in range(150)] + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(100)]
    points += [(rng.gauss(0, 1), -179.9) for _ in range(30)] + [(89.9, 100.0), (-89.9, -100.0), (90.0, 180.0), (0.0, 180.0), (0.0, -180.0)]
    points = [(i, la, lo, "x") for i, (la, lo) in enumerate(points)]
    want = brute(points, centres)
    for m, r in run(spark, points, centres).items():
        assert r.anchorage_id == want[m][2] and abs(r.distance_km - want[m][0]) < 1e-6, (m, r, want[m])


def test_ties_copies_and_missing_positions(spark):
    centres = [("late", 9, 10.0, 10.0), ("early", 2, 10.0, 10.0), ("west", 4, 0.0, -1.0), ("east", 3, 0.0, 1.0), ("bad", 1, None, 0.0), ("worse", 0, 95.0, 0.0)]
    points = [(1, 10.0, 10.1, "x"), (2, 0.0, 0.0, "x"), (3, None, 1.0, "x"), (4, float("nan"), 1.0, "x"), (5, 10.0, 10.1, "x"), (6, 0.0, 200.0, "x")]
    got = run(spark, points, centres, leaf=1)
    assert {m: r.anchorage_id for m, r in got.items()} == {1: "early", 2: "east", 3: None, 4: None, 5: "early", 6: None}
    assert got[3].distance_km is None and abs(got[1].distance_km - got[5].distance_km) == 0


def test_no_centre_or_no_point(spark):
    assert {m: r.anchorage_id for m, r in run(spark, [(1, 10.0, 10.0, "x")], []).items()} == {1: None}
    assert run(spark, [], [("c", 1, 1.0, 1.0)]) == {}
