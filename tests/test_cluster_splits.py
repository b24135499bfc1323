"""DBSCAN semantics and split invariants."""

import datetime as dt

from wakeline.operators.cluster import anchorage_dbscan
from wakeline.operators.splits import group_folds, group_split


def test_dbscan_core_border_noise(spark):
    # four events within 2 km form a core group; one 1.5 km further is border; one far away is noise
    pts = [(1, 1, 54.0, 8.0), (2, 1, 54.001, 8.0), (3, 1, 54.002, 8.0), (4, 1, 54.003, 8.0),
           (5, 1, 54.0165, 8.0), (6, 1, 55.0, 8.0)]
    ev = spark.createDataFrame(
        [(m, n, la, lo, 3, 1.0, dt.datetime(2024, 1, 1)) for m, n, la, lo in pts],
        "mmsi long, stop_event_no long, center_lat double, center_lon double, point_count long,"
        " duration_hours double, start_timestamp timestamp",
    )
    got = {r.mmsi: r.anchorage_id for r in anchorage_dbscan(ev, 2.0, 4).collect()}
    assert got[1] == got[2] == got[3] == got[4] == "anchorage_000"
    assert got[5] == "anchorage_000" and got[6] == "noise"


def test_group_split_and_folds_disjoint(spark):
    rows = [(g, i, "ab"[i % 2]) for g in range(50) for i in range(g % 7 + 1)]
    df = spark.createDataFrame(rows, "mmsi long, rid long, label string")
    sp = group_split(df, "mmsi", 0.2)
    sides = sp.groupBy("mmsi").agg({"is_test": "max"}).join(sp.groupBy("mmsi").agg({"is_test": "min"}), "mmsi").collect()
    assert all(r[1] == r[2] for r in sides)
    assert sp.count() == len(rows) and sp.where("is_test").select("mmsi").distinct().count() == 10
    f = group_folds(df, "mmsi", "label", 3)
    assert f.groupBy("mmsi").agg({"fold": "max"}).join(f.groupBy("mmsi").agg({"fold": "min"}), "mmsi").where(
        "`max(fold)` <> `min(fold)`").count() == 0


def _brute_dbscan(pts, eps, ms):
    import math

    def d(a, b):
        p, q = math.radians(a[2]), math.radians(b[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h)))

    near = [[j for j in range(len(pts)) if d(pts[i], pts[j]) <= eps] for i in range(len(pts))]
    core = [len(x) >= ms for x in near]
    lab = list(range(len(pts)))

    def find(i):
        while lab[i] != i:
            i = lab[i]
        return i

    for i in range(len(pts)):
        for j in near[i]:
            if core[i] and core[j]:
                a, b = find(i), find(j)
                lab[max(a, b)] = min(a, b)
    order = {r: k for k, r in enumerate(sorted({find(i) for i in range(len(pts)) if core[i]}))}
    return {pts[i][:2]: order[find(i)] if core[i] else min((order[find(j)] for j in near[i] if core[j]), default=-1) for i in range(len(pts))}


def test_dbscan_ports_chains_and_date_line(spark):
    import random

    rnd = random.Random(12)
    pts = [(rnd.gauss(54, 0.004), rnd.gauss(8, 0.004)) for _ in range(250)]  # a dense port
    pts += [(10 + 0.0099 * i, 179.95 + 0.009 * i if i < 6 else 179.95 + 0.009 * i - 360) for i in range(90)]  # a long chain over the date line
    pts += [(10 + 0.0099 * i, 20.0) for i in range(60) for _ in range(2)]
    pts += [(rnd.uniform(40, 40.3), rnd.uniform(3, 3.3)) for _ in range(150)] + [(89.99, rnd.uniform(-180, 180)) for _ in range(10)]
    rnd.shuffle(pts)
    rows = [(k // 7, k % 7, la, lo if lo < 180 else lo - 360) for k, (la, lo) in enumerate(pts)]
    ev = spark.createDataFrame(
        [(m, n, la, lo, 3, 1.0, dt.datetime(2024, 1, 1)) for m, n, la, lo in rows],
        "mmsi long, stop_event_no long, center_lat double, center_lon double, point_count long,"
        " duration_hours double, start_timestamp timestamp",
    )
    got = {(r.mmsi, r.stop_event_no): r.anchorage_cluster for r in anchorage_dbscan(ev, 2.0, 4).collect()}
    assert got == _brute_dbscan(rows, 2.0, 4)


def test_dbscan_skewed_dense_cells(spark):
    import math

    # cells two columns apart with their points in far corners; only the edge points are within 2 km of each other
    side = 0.7 * math.degrees(2.0 / 6371.0088)
    band = int((54.0 + 90) / side)
    low = band * side - 90
    width = 360.0 / math.ceil(360.0 * math.cos(math.radians(low)) / side)
    west = int(188.0 / width) * width - 180
    pts = [(low + 0.02 * side, west + (0.02 + 0.001 * i) * width) for i in range(19)] + [(low + 0.5 * side, west + 0.99 * width)]
    pts += [(low + 0.98 * side, west + (2.98 - 0.001 * i) * width) for i in range(19)] + [(low + 0.5 * side, west + 2.01 * width)]
    rows = [(k, 0, la, lo) for k, (la, lo) in enumerate(pts)]
    ev = spark.createDataFrame(
        [(m, n, la, lo, 3, 1.0, dt.datetime(2024, 1, 1)) for m, n, la, lo in rows],
        "mmsi long, stop_event_no long, center_lat double, center_lon double, point_count long,"
        " duration_hours double, start_timestamp timestamp",
    )
    got = {(r.mmsi, r.stop_event_no): r.anchorage_cluster for r in anchorage_dbscan(ev, 2.0, 4).collect()}
    assert set(got.values()) == {0} and got == _brute_dbscan(rows, 2.0, 4)
