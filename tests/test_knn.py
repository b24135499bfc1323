"""The k-nearest-neighbour join and vote against brute force."""

import math
import random
from functools import reduce
from operator import add

import pytest

from wakeline.operators import knn

ROWS, QUERIES = "rid long, x array<double>, label string, extra string", "rid long, x array<double>"


def brute(rows, queries, k):
    out = {}
    for q, x in queries:
        if x is not None:
            d = sorted((reduce(add, ((a - b) * (a - b) for a, b in zip(x, y, strict=True)), 0.0), t, label) for t, y, label, _ in rows if y is not None)
            out[q] = d[:k]
    return out


def check(spark, rows, queries, k):
    got = {}
    near = knn.nearest_rows(spark.createDataFrame(rows, ROWS), spark.createDataFrame(queries, QUERIES), k)
    for r in near.collect():
        got.setdefault(r["query"], []).append((r["rank"], r.neighbour, r.label, r.distance))
    want = {q: [(i, t, label, math.sqrt(d)) for i, (d, t, label) in enumerate(n, 1)] for q, n in brute(rows, queries, k).items() if n}
    assert {q: sorted(n) for q, n in got.items()} == want
    return near


def grid(rng, n, dim, top):
    return [(i, [float(rng.randrange(top)) for _ in range(dim)], rng.choice("abc"), "e") for i in range(n)]


@pytest.mark.parametrize("dim,top", [(2, 12), (4, 5), (9, 1000)])
def test_against_brute_force_with_ties(spark, dim, top):
    rng = random.Random(dim)
    check(spark, grid(rng, 900, dim, top), [(i, [float(rng.randrange(-2, top + 2)) for _ in range(dim)]) for i in range(150)], 7)


def test_copies_hold_a_third_of_rows_and_queries(spark, monkeypatch):
    monkeypatch.setattr(knn, "CELL_ROWS", 8)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 5)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 4)
    rng = random.Random(5)
    rows = grid(rng, 400, 3, 30) + [(1000 + i, [3.0, 4.0, 5.0], "abc"[i % 3], "e") for i in range(200)] + [(5000, None, "a", "e")]
    queries = [(i, [rng.uniform(0, 30) for _ in range(3)]) for i in range(80)] + [(1000 + i, [3.0, 4.0, 5.5]) for i in range(40)] + [(7, None)]
    check(spark, rows, queries, 7)


def test_far_queries_and_few_rows(spark):
    rows = [(i, [float(i), 0.0], "a", "e") for i in range(5)]
    check(spark, rows, [(1, [1e6, -1e6]), (2, [2.0, 0.0])], 7)
    check(spark, rows, [(1, [0.5, 0.0])], 1)
    check(spark, [], [(1, [0.5, 0.0])], 7)
    check(spark, rows, [], 7)


def test_skewed_clusters(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1e-3), rng.gauss(0, 1e-3)], "a", "e") for i in range(1500)]
    rows += [(2000 + i, [rng.gauss(50, 9), rng.gauss(-50, 9)], "b", "e") for i in range(300)]
    check(spark, rows, [(i, [rng.gauss(0, 20), rng.gauss(0, 20)]) for i in range(60)] + [(100 + i, [rng.gauss(0, 1e-3), 0.0]) for i in range(60)], 7)


def test_vote(spark):
    near = spark.createDataFrame(
        [(1, 1, 10, "b", 1.0), (1, 2, 11, "a", 2.0), (1, 3, 12, "a", 2.0),  # equal sums: the smaller label
         (2, 1, 10, "b", 0.0), (2, 2, 11, "a", 0.1), (2, 3, 12, "a", 0.1),  # distance zero weighs alone
         (3, 1, 10, "b", 2.0), (3, 2, 11, "a", 4.0)],
        "query long, rank int, neighbour long, label string, distance double")
    got = {r["query"]: (r.prediction, round(r.probability, 6)) for r in knn.weighted_vote(near).collect()}
    assert got == {1: ("a", 0.5), 2: ("b", 1.0), 3: ("b", round(2 / 3, 6))}
