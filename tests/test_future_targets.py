"""The as-of join: brute force over days and copies, and what it shuffles."""

import datetime as dt
import random
import re

from wakeline.operators.joins import future_targets

COLUMNS = "mmsi long, rid long, ts timestamp, lat double, lon double"
T0 = dt.datetime(2024, 1, 1)


def test_brute_force_across_days(spark):
    rnd = random.Random(5)
    at = [(v, rnd.randrange(0, 5 * 1440, 5)) for v in (1, 2) for _ in range(150)] + [(2, 1435), (2, 1440), (2, 1445), (3, 0), (3, 60), (3, 120)]
    rows = [(v, i, T0 + dt.timedelta(minutes=m), float(rnd.randrange(4)), float(i)) for i, (v, m) in enumerate(at)]
    rows += [rows[7], (4, None, T0, 1.0, 1.0), (None, 9000, T0, 1.0, 1.0), (1, 9001, None, 1.0, 1.0)]
    for horizons, tolerance in (([1, 2, 3], 45), ([1], 1500), ([30], 200)):
        want = []
        for v, i, t, lat, lon in rows:
            if v is None or i is None or t is None or sum(r[0] == v for r in rows) < max(horizons) + 1:
                continue
            picks = []
            for h in horizons:
                shifted = [(r[2] - dt.timedelta(hours=h), r[3], r[4], r[1], r[2]) for r in rows if r[0] == v and r[2] is not None]
                tol = dt.timedelta(minutes=tolerance)
                back = max((s for s in shifted if t - tol <= s[0] <= t), default=None, key=lambda s: s[:4])
                ahead = min((s for s in shifted if t < s[0] <= t + tol), default=None, key=lambda s: s[:4])
                if back and not (ahead and ahead[0] - t < t - back[0]):
                    picks += [back[4], back[1], back[2]]
                elif ahead:
                    picks += [ahead[4], ahead[1], ahead[2]]
            if len(picks) == 3 * len(horizons):
                want.append((v, i, *picks))
        got = future_targets(spark.createDataFrame(rows, COLUMNS), horizons, tolerance)
        cols = [f"target_{c}_{h}h" for h in horizons for c in ("timestamp", "lat", "lon")]
        assert sorted(map(tuple, got.select("mmsi", "rid", *cols).collect())) == sorted(want), (horizons, tolerance)


def test_points_are_shuffled_before_they_are_multiplied(spark, capsys):
    rows = [(1, i, T0 + dt.timedelta(minutes=7 * i), 1.0, 1.0) for i in range(60)]
    future_targets(spark.createDataFrame(rows, COLUMNS)).explain()
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", capsys.readouterr().out)
    assert keys and not any("_h#" in k for k in keys)
