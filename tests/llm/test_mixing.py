"""Mixing: targets, words taken and positions against a plain version."""

import hashlib
import re

import pytest

from wakeline.llm import mixing

SCHEMA = "doc_id long, text string, source string, target string"


def plain(rows):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    size = {}
    for _, t, s, _ in rows:
        size[s] = size.get(s, 0) + len(words(t))
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(size.values()), set()
    while True:
        left, w = total - sum(3 * size[s] for s in full), sum(weight[s] for s in order if s not in full)
        target = {s: 3.0 * size[s] if s in full else left * weight[s] / w if w else 0.0 for s in order}
        more = {s for s in order if s not in full and target[s] >= 3 * size[s]}
        if not more:
            break
        full |= more
    taken = []
    for s in order:
        passes = int(target[s] // size[s]) if size[s] else 0
        rest = int(target[s] - passes * size[s] + 0.5)
        docs = sorted(((hashlib.md5(f"mix-1:{'null' if k is None else k}".encode()).hexdigest(), -1 if k is None else k, len(words(t)), t) for k, t, z, _ in rows if z == s), key=lambda x: x[:3])
        for _, k, n, t in docs:
            part = max(0, min(n, rest))
            rest -= n
            taken.append((s, k, n, size[s], round(target[s], 6), passes * n + part))
    return sorted(taken, key=str), target


CASES = {
    "few": [(i, "w " * (i % 9), f"s{i % 5}", "x") for i in range(60)] + [(100, None, "s0", "x"), (101, "", None, "x"), (102, "a b\x0bc", None, "x")],
    "capped": [(0, "tiny", "c", "x"), (1, "a b c", "b", "x")] + [(i, "w " * 40, "a", "x") for i in range(2, 40)],
    "repeated": [(7, "one two three", "é", "x")] * 4 + [(None, "x y", "z", "x"), (8, "ab " * 11, "\U0001f389", "x")],
    "empty": [], "no words": [(1, "", "a", "x"), (2, None, None, "x")],
}


@pytest.mark.parametrize("name", CASES)
def test_plan(spark, name):
    rows = CASES[name]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.plan(docs).collect()
    got = sorted(((r.source, -1 if r.id is None else r.id, r.size, r.source_size, round(r.target, 6), r.taken) for r in out), key=str)
    want, target = plain(rows)
    assert got == want
    for r in out:
        assert r.taken <= 3 * r.size and sum(c.words for c in r.copies or []) == r.taken
        assert all(0 <= c.position <= 1 for c in r.copies or [])
    for s, t in target.items():
        assert abs(sum(r.taken for r in out if r.source == s) - t) <= 0.5 + 1e-6
    mixed = mixing.mix(docs).collect()
    assert sum(len(r.text.split()) for r in mixed) == sum(r.taken for r in out)
    assert not mixed or list(mixed[0].asDict()) == ["doc_id", "text", "source", "target"]


def test_position_inverts_the_demand(spark):
    from pyspark.sql import functions as F

    xs = [i / 40 for i in range(41)]
    df = spark.createDataFrame([(x, k) for x in xs for k in range(3)], "x double, k int")
    for r in df.select("x", "k", mixing._time(F.col("x"), F.col("k"), mixing.SCHEDULES).alias("t")).collect():
        rates = mixing.SCHEDULES[r.k]
        n, step, area, whole = 4000, 1 / (len(rates) - 1), 0.0, 0.0
        for i in range(n):
            m = (i + 0.5) / n
            k = min(int(m / step), len(rates) - 2)
            rate = rates[k] + (rates[k + 1] - rates[k]) * (m / step - k)
            whole += rate / n
            area += rate / n if m < r.t else 0
        assert abs(area / whole - r.x) < 2e-3


def test_native(spark):
    docs = spark.createDataFrame(CASES["few"], SCHEMA)
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_plan_in_training_order(spark):
    rows = [(i, "a b c d " * (1 + i % 5), "abc"[i % 3]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = [r.position for r in mixing.in_order(mixing.plan(docs)).collect()]
    taken = [p for p in out if p is not None]
    assert len(out) == 120 and taken == sorted(taken) and out[: len(taken)] == taken
