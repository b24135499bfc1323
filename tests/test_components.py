"""Contraction against union-find on chains, stars, random graphs and nothing."""

import random

import pytest

from wakeline.operators.components import connected_components


def brute(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            up[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(up)}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(400)],
    [(7, i) for i in range(300) if i != 7] + [(7, 7), (None, 3)],
    random.Random(5).sample([(a, b) for a in range(150) for b in range(150)], 140) * 2,
    [],
], ids=["chain", "star", "random", "empty"])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(spark, df).collect()}
    assert got == brute(edges)
