"""Hard negatives against all pairs."""

import numpy as np
import pytest

from wakeline.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, x string, score int, anchor string"
EXTRA = ("a", "b", 1, "c")


def brute(rows, every):
    ok = [(i, r[0], r[2], [int(np.floor(256 * float(c))) for c in r[1]]) for i, r in enumerate(rows)
          if r[2] is not None and r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    out = []

    def key(t):
        return (-t[0], t[1] is None, t[1] or 0)

    for i, vid, label, x in ok:
        if vid is None or vid % every:
            continue
        scored = [(sum(a * b for a, b in zip(x, y, strict=True)), v, m) for j, v, m, y in ok if j != i and len(y) == len(x)]
        for p, pid, _ in sorted((s for s in scored if s[2] == label), key=key)[:5]:
            hard = sorted((s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p), key=key)[:3]
            out += [(vid, pid, rank, nid, p, s) for rank, (s, nid, _) in enumerate(hard, 1)]
    return sorted(out, key=str)


def run(spark, rows, every=5, parts=3):
    table = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(parts)
    out = negatives.mine(table, f"vec_id % {every} = 0")
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def data(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    x = centre[rng.integers(0, 6, n)] + 0.7 * rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, np.float32(v).tolist(), int(m)) for i, (v, m) in enumerate(zip(x, rng.integers(0, labels, n), strict=True))]


@pytest.mark.parametrize("dim", [1, 8, 13, 64])
def test_scores_are_inner_products(dim):
    rng = np.random.default_rng(dim)
    for low, high in ((-256, 256), (0, 1), (-(1 << 26), 1 << 26), (5, 5)):
        a, b = rng.integers(low, high + 1, (7, dim)), rng.integers(low, high + 1, (9, dim))
        planes = max(1, (high - low).bit_length())
        got = negatives.Scorer(a, low, planes)(negatives.bit_planes(b, low, planes))
        assert (got == b @ a.T).all()


def test_against_all_pairs(spark):
    rows = data(400, 20, 1)
    got = run(spark, rows)
    assert got == brute(rows, 5) and len(got) > 300


def test_small_blocks_and_pieces(spark, monkeypatch):
    rows = data(150, 12, 2, labels=2)
    monkeypatch.setattr(negatives, "_blocks", lambda n, *_: 5)
    monkeypatch.setattr(negatives, "PIECE", 4)
    monkeypatch.setattr(negatives, "TABLE_ANCHORS", 3)
    assert run(spark, rows, 3) == brute(rows, 3)


def test_odd_rows(spark):
    rows = data(60, 9, 3, labels=3)
    v = rows[5][1]
    rows += [(500, None, 1), (505, v, None), (510, [None] * 9, 1), (515, [float("nan")] * 9, 1), (520, [float("inf")] * 9, 1),
             (525, v[:4], 1), (530, v[:4], 1), (535, [c / 2 for c in v[:4]], 2), (540, [], 1), (545, [], 2), (550, [], 1),
             (None, v, 1), (None, v, 2), (5, v, rows[5][2]), (555, [0.0] * 9, 1), (560, [-c for c in v], 1)]
    rows += [(600 + i, v, i % 3) for i in range(40)]  # ties
    got, want = run(spark, rows), brute(rows, 5)
    assert got == want and any(r[0] == 540 for r in got)


def test_empty_and_single(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, [1.0, 0.5], 1)]) == []
    assert run(spark, [(6, [1.0, 0.5], 1), (7, [1.0, 0.5], 1)]) == []
