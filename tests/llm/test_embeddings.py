"""Embedding near-dedup against all pairs."""

import numpy as np
import pytest

from wakeline.llm import embeddings
from wakeline.scratch import Scratch

SCHEMA = "vec_id long, embedding array<float>, n_links string"


def data(n, dim, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = list(base)
    for i in range(0, n, 3):  # cosines between 0.94 and 0.999 with the original
        away = rng.normal(size=dim)
        away -= away @ base[i] * base[i]
        away /= np.linalg.norm(away)
        c = rng.uniform(0.94, 0.999)
        rows.append(c * base[i] + np.sqrt(1 - c * c) * away)
    rows += [base[1]] * 5 + [base[2] * 7.5]
    return [np.float32(r).tolist() for r in rows]


def brute(rows):
    ok = [r[1] is not None and len(r[1]) and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    x = [np.array(r[1], dtype=float) / np.linalg.norm(np.array(r[1], dtype=float)) if o else None for r, o in zip(rows, ok)]
    n = len(rows)
    up, links = list(range(n)), [0] * n

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    low = {}
    for i in range(n):
        low.setdefault(find(i), []).append(rows[i][0])
    low = {r: min((v for v in vs if v is not None), default=None) for r, vs in low.items()}
    return [(rows[i][0], links[i], low[find(i)], rows[i][0] == low[find(i)]) for i in range(n)]


@pytest.mark.parametrize("cell_rows,block", [(512, 2048), (30, 16)], ids=["one-cell", "cells-and-blocks"])
def test_against_all_pairs(spark, cell_rows, block):
    rows = [(i, e, "clash") for i, e in enumerate(data(150, 16, 5))]
    odd = [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + i, e, "clash") for i, e in enumerate(odd)] + [(None, rows[4][1], "c"), (7, rows[7][1], "c"), (None, None, "c")]
    out = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), margin=1.0, cell_rows=cell_rows, block=block).collect()
    key = lambda t: str(t)
    want = [(a, b, c, (a == c)) for a, b, c, _ in brute(rows)]
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out), key=key) == sorted(want, key=key)


def test_recall_of_default_margin(spark):
    rows = [(i, e, "") for i, e in enumerate(data(1500, 64, 6))]
    out = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), cell_rows=64).collect()}
    want = {k: (n, c) for k, n, c, _ in brute(rows)}
    assert all(out[k].n_links <= n for k, (n, _) in want.items())
    assert sum(r.n_links for r in out.values()) >= 0.97 * sum(n for n, _ in want.values())


def test_empty(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_links_count_at_both_ends(spark):
    # pairs in a subspace of 6 of 64 dimensions, where many are found from one end only
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(400, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rnd.normal(size=x.shape)
    u -= (u * x).sum(axis=1, keepdims=True) * x
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    x = np.r_[x, 0.955 * x + np.sqrt(1 - 0.955**2) * u] @ np.linalg.qr(rnd.normal(size=(64, 6)))[0].T
    table = spark.createDataFrame([(i, e) for i, e in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = embeddings.near_duplicates(table, cell_rows=20).collect()
    true = (x @ x.T >= embeddings.COSINE).sum(axis=1) - 1
    group = {}
    for r in got:
        group.setdefault(r.component_id, []).append(r.n_links)
        assert r.n_links <= true[r.vec_id]
    assert all(sum(g) % 2 == 0 and (len(g) == 1 or min(g) > 0) for g in group.values())


def test_copies_are_made_in_waves(spark, monkeypatch):
    # copies of all visits were shuffled at once; what a wave shuffles is bounded, and the result is the same
    rows = [(i, e, "") for i, e in enumerate(data(300, 32, 3))]
    table = spark.createDataFrame(rows, SCHEMA)
    most = []
    written = Scratch.write

    def write(self, df, name, **options):
        out = written(self, df, name, **options)
        if name == "links":
            most.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "write", write)
    monkeypatch.setattr(embeddings, "WAVE_BYTES", 1)
    out = embeddings.near_duplicates(table, margin=1.0, cell_rows=40, block=25).collect()
    assert len(most) > 3
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out) == sorted((a, b, c, a == c) for a, b, c, _ in brute(rows))


def test_a_wave_takes_its_share_of_the_copies():
    # one home block of 10 among 1,000 vectors: 10 x 40 copies as queries and 1,000 as others, not 40 x 1,010
    plans, waves = embeddings._plan([(64, 0, 10, 1000), (64, 2, 0, 50), (64, 3, 60, 60)], 25, 4, 100_000)
    homes, others, before, each = plans[64]
    assert homes.tolist() == [1, 0, 0, 3] and others.tolist() == [40, 0, 2, 3]
    assert each[0] == (10 * 40 + 1000) * 320 and before[3] == each[0] and waves == (each[0] + 3 * each[3]) // 100_000 + 1
