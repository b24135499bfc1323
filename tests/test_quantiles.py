"""Grouped quantiles against numpy."""

import random

import numpy as np
import pytest

from wakeline.operators import quantiles
from wakeline.operators.cluster import anomaly_thresholds

Q = [0.0, 0.25, 0.5, 0.95, 1.0]


def groups():
    rng = random.Random(3)
    out = {"hot": [rng.gauss(0, 1) for _ in range(3000)], "ties": [float(rng.randrange(4)) for _ in range(501)], "one": [7.5],
           "two": [1.0, 2.0], "same": [3.0] * 9, "wide": [10.0 ** rng.uniform(-9, 9) for _ in range(200)], "close": [1.0 + i * 2.0**-52 for i in range(40)]}
    return out


@pytest.mark.parametrize("cells", [4096, 3])
def test_against_numpy(spark, monkeypatch, cells):
    monkeypatch.setattr(quantiles, "CELLS", cells)
    data = groups() if cells > 3 else {k: v for k, v in groups().items() if k in ("ties", "two", "one", "same")}
    rows = [(g, 1, v) for g, vs in data.items() for v in vs] + [("hot", 1, None), ("none", 1, None), ("one", 1, float("nan"))]
    out = quantiles.grouped_quantiles(spark.createDataFrame(rows, "g string, k int, x double"), ["g", "k"], Q, "x").collect()
    got = {(r.g, r.q): r.value for r in out}
    assert set(got) == {(g, q) for g in data for q in Q}
    for (g, q), v in got.items():
        at = sorted(data[g])
        p = (len(at) - 1) * q
        lo, hi = int(np.floor(p)), int(np.ceil(p))
        assert v == (at[lo] if lo == hi else (hi - p) * at[lo] + (p - lo) * at[hi])


def test_thresholds_per_route_and_global(spark):
    data = {k: [abs(v) for v in vs] for k, vs in groups().items() if k in ("hot", "ties", "one")}
    rows = [(i, g, v) for g, vs in data.items() for i, v in enumerate(vs)]
    out = {r.route_label: r for r in anomaly_thresholds(spark.createDataFrame(rows, "mmsi long, route_label string, route_distance double")).collect()}
    every = [v for vs in data.values() for v in vs]
    for label, vs in [*data.items(), (None, every)]:
        assert abs(out[label].threshold - np.quantile(vs, 0.95)) < 1e-12 and out[label].vessels == len(vs)
        assert abs(out[label].std_distance - np.std(vs)) < 1e-9
    assert not spark.catalog.listTables()
