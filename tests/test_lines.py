"""Map-line operators against plain per-track code, and their plans."""

import datetime as dt
import math
import random
import re

import pytest

from wakeline.functions.geo import EARTH_RADIUS_KM
from wakeline.operators import track as T
from wakeline.operators.mapview import actual_tracks, representative_track
from wakeline.operators.sequence import mark_scan

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "mmsi long, ts timestamp, lat double, lon double, cog double"


def hav(a, b):
    p1, p2 = math.radians(a[2]), math.radians(b[2])
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
    return EARTH_RADIUS_KM * 2 * math.asin(min(1.0, math.sqrt(x)))


def tracks(seed=4):
    rng = random.Random(seed)
    out = []
    for k, n in enumerate([1, 2, 3, 40, 90, 91, 92, 200, 400, 5]):
        t, lat, lon = T0, 54.0, 8.0
        for _ in range(n):
            t += dt.timedelta(minutes=rng.choice([5, 90, 400, 3000]))
            if rng.random() < 0.7:
                lat, lon = round(lat + rng.uniform(-0.3, 0.3), 3), round(lon + rng.choice([0.1, 0.2, 1.9]), 3) % 60
            out.append((k, t, lat, lon, rng.choice([None, float("nan"), 12.0, 361.0])))
    out += [(50, T0, 10.0, 10.0, None), (50, T0 + dt.timedelta(days=1), 20.0, 10.0, None), (50, T0 + dt.timedelta(days=2), 30.0, 10.0, None)]
    out += [(60, T0 + dt.timedelta(hours=9 * i), 10.0, 10.0, None) for i in range(7)]  # never moves
    out += [(70, T0, 10.0, 10.0, None), (70, T0 + dt.timedelta(days=3), None, 10.0, 5.0), (70, T0 + dt.timedelta(days=4), 91.0, 10.0, None)]
    rng.shuffle(out)
    return out


def by_vessel(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[3])) for k, v in out.items()}


def line(rows, top):
    ok = [r for r in rows if r[2] is not None and -90 <= r[2] <= 90 and -180 <= r[3] <= 180]
    moved = [r for i, r in enumerate(ok) if not i or r[2:4] != ok[i - 1][2:4]]
    n = len(moved)
    at = range(n) if n <= top else [round(i * (n - 1) / (top - 1)) for i in range(top)]
    return [moved[j] for j in at]


def pieces(rows):
    groups = [[rows[0]]]
    for a, b in zip(rows, rows[1:], strict=False):
        if hav(a, b) > 80.0:
            groups.append([])
        groups[-1].append(b)
    good = [(i, r) for i, g in enumerate(groups) for r in g if len(g) > 1]
    return good or [(0, r) for r in rows]


@pytest.mark.parametrize("top", [90, 10, 2])
def test_line_and_pieces(spark, top):
    rows = tracks()
    found = T.track_line_points(spark.createDataFrame(rows, SCHEMA), top)
    got = {}
    for r in found.collect():
        got.setdefault(r.mmsi, []).append((r.keep_idx, r.ts, r.lat, r.lon, r.kept))
    want = {k: line(v, top) for k, v in by_vessel(rows).items()}
    assert {k: sorted(v) for k, v in got.items()} == {k: [(i, *r[1:4], len(v)) for i, r in enumerate(v)] for k, v in want.items() if v}
    split = T.split_gaps(found.select("mmsi", "ts", "lat", "lon"))
    assert sorted((r.mmsi, r.piece, r.ts) for r in split.collect()) == sorted((k, i, r[1]) for k, v in want.items() if v for i, r in pieces(v))


def test_downsample_counts_every_point(spark):
    rows = [r for r in tracks() if r[2] is not None]
    got = {}
    for r in T.downsample_track(spark.createDataFrame(rows, SCHEMA), 10).collect():
        got.setdefault(r.mmsi, []).append((r.keep_idx, r.idx, r.ts, r.n))
    for k, v in by_vessel(rows).items():
        n = len(v)
        at = range(n) if n <= 10 else [round(i * (n - 1) / 9) for i in range(10)]
        assert sorted(got[k]) == [(i, j, v[j][1], n) for i, j in enumerate(at)]


def test_latest_bearing(spark):
    rows = tracks()
    points = spark.createDataFrame(rows, SCHEMA)
    got = {r.mmsi: r.bearing for r in T.latest_bearing(points, T.track_line_points(points)).collect()}
    for k, v in by_vessel(rows).items():
        cog = [r[4] for r in v if r[4] is not None and not math.isnan(r[4])]
        if cog and 0 <= cog[-1] <= 360:
            assert got[k] == cog[-1]
            continue
        a = line(v, 90)[-2:]
        if len(a) < 2:
            assert got[k] == 0.0
            continue
        (p1, l1), (p2, l2) = ((math.radians(r[2]), math.radians(r[3])) for r in a)
        y, x = math.sin(l2 - l1) * math.cos(p2), math.cos(p1) * math.sin(p2) - math.sin(p1) * math.cos(p2) * math.cos(l2 - l1)
        assert abs((got[k] - math.degrees(math.atan2(y, x)) + 180) % 360 - 180) < 1e-6


@pytest.mark.parametrize("hours", [1, 24, 10_000])
def test_mark_scan_over_buckets(spark, hours):
    rows = [r for r in tracks(9) if r[2] is not None]
    out = mark_scan(spark.createDataFrame(rows, SCHEMA), "lat < prev_lat", prev=["lat"], first=True, bucket_seconds=3600 * hours)
    got = {(r.mmsi, r.ts): r for r in out.collect()}
    for k, v in by_vessel(rows).items():
        marks = [i == 0 or v[i][2] < v[i - 1][2] for i in range(len(v))]
        for i, r in enumerate(v):
            g = got[(k, r[1])]
            assert (g._mark, g._run, g._marks, g._rows, g._head) == (marks[i], sum(marks[: i + 1]), sum(marks), len(v), i == 0)
            assert g._next == (marks[i + 1] if i + 1 < len(v) else None)


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def point_shuffles(df):
    """Shuffles by vessel and day that are made, of rows: not of summaries, which
    are partial aggregates or dealt out by repartition."""

    lines = final_plan(df).splitlines()
    made = [x for x, below in zip(lines, lines[1:], strict=False) if re.search(r"\bExchange hashpartitioning\(mmsi#\d+L, _wl_bucket", x)
            and "ReusedExchange" not in x and "REPARTITION" not in x and "partial_" not in below]
    return len(made)


def test_plans_shuffle_the_points_once(spark, tmp_path):
    spark.createDataFrame(tracks(), SCHEMA).write.parquet(str(tmp_path / "p"))
    points = spark.read.parquet(str(tmp_path / "p"))
    selected = points.select("mmsi").distinct()
    one = T.track_line_points(points)
    assert point_shuffles(one) == 1
    assert point_shuffles(T.downsample_track(points, 90)) == 1
    assert point_shuffles(T.stop_event_points(points.selectExpr("*", "1.0D AS sog"))) == 1
    assert point_shuffles(actual_tracks(points, selected)) == 1
    # the points, then the few of the line
    split = T.split_gaps(one.select("mmsi", "ts", "lat", "lon"))
    assert point_shuffles(split) == 2
    rep = points.groupBy().agg({"mmsi": "max"}).selectExpr("`max(mmsi)` AS representative_mmsi", "'r' AS predicted_route")
    assert point_shuffles(representative_track(rep, points)) == 2
    text = final_plan(split)
    assert text.count("Scan parquet") == 1, text
    assert point_shuffles(T.latest_bearing(points, one)) == 1
    assert final_plan(T.latest_bearing(points, one)).count("Scan parquet") == 2
