"""The bucketed track scan equals a plain per-track scan (brute force)."""

import datetime as dt
import random

from wakeline.operators.sequence import track_scan


def _rows(n_tracks=4, n=40, seed=1):
    rng = random.Random(seed)
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for k in range(n_tracks):
        t = t0
        for i in range(n):
            t += dt.timedelta(minutes=rng.choice([5, 30, 200, 900, 3000]))
            v = rng.choice([None, float(i)])
            rows.append((k, t, float(rng.randint(0, 9)), float(i), v))
    return rows


def test_scan_matches_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "mmsi long, ts timestamp, lat double, lon double, v double")
    out = track_scan(df, key="mmsi", order=("ts", "lat", "lon"), prev=["lon"], next=["lon"], index="i",
                     cumsum={"s": "lon"}, ffill=["v"], bfill=["v"], track_first=["lon"], track_last=["lon"],
                     track_count="n", bucket_seconds=3600 * 6).collect()
    got = {(r.mmsi, r.lon): r for r in out}
    for k in {r[0] for r in rows}:
        tr = sorted([r for r in rows if r[0] == k], key=lambda r: (r[1], r[2], r[3]))
        run = 0.0
        for j, r in enumerate(tr):
            g = got[(k, r[3])]
            run += r[3]
            assert g.prev_lon == (tr[j - 1][3] if j else None)
            assert g.next_lon == (tr[j + 1][3] if j + 1 < len(tr) else None)
            assert g.i == j and abs(g.s - run) < 1e-9
            back = [x[4] for x in tr[: j + 1] if x[4] is not None]
            fwd = [x[4] for x in tr[j:] if x[4] is not None]
            assert g.ffill_v == (back[-1] if back else None)
            assert g.bfill_v == (fwd[0] if fwd else None)
            assert g.track_first_lon == tr[0][3] and g.track_last_lon == tr[-1][3] and g.n == len(tr)
