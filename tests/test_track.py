"""Edge cases of the sequence operators (FIXTURES.md §5)."""

import datetime as dt

from wakeline.operators.track import stop_event_points, stop_events, track_signature
from wakeline.operators.vessel import early_track

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "mmsi long, ts timestamp, lat double, lon double, sog double"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_stop_gap_exactly_three_hours_merges(spark):
    rows = [(1, T0, 54.0, 8.0, 0.5), (1, T0 + dt.timedelta(hours=3), 54.0, 8.0, 0.5),
            (2, T0, 54.0, 8.0, 0.5), (2, T0 + dt.timedelta(hours=3, seconds=1), 54.0, 8.0, 0.5),
            (3, T0, 54.0, 8.0, 0.5), (3, T0 + dt.timedelta(hours=1), 54.0, 8.0, 12.0),
            (3, T0 + dt.timedelta(hours=2), 54.0, 8.0, 0.2)]
    ev = {r.mmsi: r.n for r in stop_events(_df(spark, rows)).groupBy("mmsi").count().withColumnRenamed("count", "n").collect()}
    assert ev == {1: 1, 2: 2, 3: 1}
    pts = stop_event_points(_df(spark, rows)).groupBy("mmsi").agg({"stop_event_no": "max"}).collect()
    assert {r[0]: r[1] for r in pts} == {1: 1, 2: 2, 3: 1}


def test_signature_single_point_and_equal_times(spark):
    rows = [(1, T0, 54.0, 8.0, 1.0),
            (2, T0, 54.0, 8.0, 1.0), (2, T0, 55.0, 9.0, 1.0), (2, T0, 56.0, 10.0, 1.0),
            (3, T0, 54.0, 8.0, 1.0), (3, T0 + dt.timedelta(hours=1), 55.0, 8.0, 1.0),
            (3, T0 + dt.timedelta(hours=1), 57.0, 8.0, 1.0), (3, T0 + dt.timedelta(hours=2), 56.0, 8.0, 1.0)]
    sig = {(r.mmsi, r.step): (r.lat, r.lon) for r in track_signature(_df(spark, rows), 5).collect()}
    assert all(sig[(1, k)] == (54.0, 8.0) for k in range(5))
    assert abs(sig[(2, 2)][0] - 55.0) < 1e-9 and sig[(2, 4)] == (56.0, 10.0)  # by index
    assert abs(sig[(3, 2)][0] - 55.0) < 1e-9  # equal times keep the first point
    assert len([k for k in sig if k[0] == 3]) == 5


def test_early_track_short_tracks(spark):
    rows = [(1, T0, 54.0, 8.0, 1.0),
            (2, T0, 54.0, 8.0, 1.0), (2, T0 + dt.timedelta(hours=20), 55.0, 8.0, 1.0),
            (3, T0, 54.0, 8.0, 1.0), (3, T0 + dt.timedelta(hours=10), 55.0, 8.0, 1.0),
            (3, T0 + dt.timedelta(hours=11), 55.5, 8.0, 1.0)]
    n = {r[0]: r[1] for r in early_track(_df(spark, rows), 6.0).groupBy("mmsi").count().collect()}
    assert n == {1: 1, 2: 2, 3: 2}
