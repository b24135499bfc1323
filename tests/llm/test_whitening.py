"""Whitening against a plain eigendecomposition."""

import numpy as np
import pytest

from wakeline.llm import whitening
from wakeline.llm.spectra import Spectrum, rank_one

SCHEMA = "vec_id long, embedding array<float>, n string, id string"


def scatter(s):
    return s.vectors @ np.diag(s.values) @ s.vectors.T


def whole(rows):
    return [[int(np.floor(64 * float(c))) + 1_000_000 for c in r] for r in rows]


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


@pytest.mark.parametrize("u", ["any", "one", "two", "none"])
def test_rank_one_with_equal_poles(u):
    rng = np.random.default_rng(1)
    values, q = np.array([0.0, 0, 1, 2, 2, 2, 7]), np.linalg.qr(rng.normal(size=(7, 7)))[0]
    u = {"any": rng.normal(size=7), "one": q[:, 4], "two": q[:, 0] + 1e-9 * q[:, 6], "none": np.zeros(7)}[u]
    d, v = rank_one(values, q, u, 0.7)
    assert np.allclose(v @ np.diag(d) @ v.T, q @ np.diag(values) @ q.T + 0.7 * np.outer(u, u), atol=1e-13)
    assert np.allclose(v.T @ v, np.eye(7), atol=1e-13) and (np.diff(d) >= 0).all()


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_spectra_of_parts_join_to_that_of_all(block):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 9)) * np.arange(1, 10) + 5
    x[:, 3] = x[:, 2]  # a singular direction
    parts = [Spectrum(9), Spectrum(9), Spectrum(9)]
    for part, rows in zip(parts, (x[:4], x[4:100], x[100:]), strict=True):
        for at in range(0, len(rows), block):
            part.add(rows[at: at + block])
    whole_ = Spectrum.from_bytes(parts[0].to_bytes())
    for part in parts[1:]:
        whole_.join(part)
    assert whole_.n == 150 and np.allclose(whole_.mean, x.mean(axis=0))
    assert np.allclose(scatter(whole_), 150 * np.cov(x.T, bias=True), rtol=1e-11, atol=1e-9)


def test_against_plain_eigenvectors(spark):
    rng = np.random.default_rng(3)
    x = np.float32(rng.normal(size=(400, 40)) * np.linspace(0.05, 1, 40)[None, :])
    rows = [(i, r.tolist(), "a", "b") for i, r in enumerate(x)] + [
        (9001, None, "a", "b"), (9002, [1.0] * 39 + [None], "a", "b"), (9003, [float("nan")] * 40, "a", "b"),
        (9004, [float("-inf")] * 40, "a", "b"), (9005, [], "a", "b"), (9006, [0.5] * 3, "a", "b")]
    rows += [(None, x[5].tolist(), "a", "b"), (7, x[7].tolist(), "a", "b")]  # a null id, a repeated row
    table = spark.createDataFrame(rows, SCHEMA).repartition(37)
    out = whitening.whiten(table).collect()
    ints = np.array(whole([*x, x[5], x[7]]))
    n, sums = len(ints), ints.sum(axis=0)
    y = ints - sums / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    assert len(out) == n * 32 and {r.vec_id for r in out} == {*range(400), None}
    found = by_id(out)
    for c in range(1, 33):
        want = y[:400] @ q[:, c - 1] / np.sqrt(e[c - 1])
        got = np.array([found[i][c].whitened for i in range(400)])
        assert np.allclose(got * np.sign(got @ want), want, atol=1e-9)
        assert abs(found[0][c].explained / (e[c - 1] / e.sum()) - 1) < 1e-10
    assert all(r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(ints[r.vec_id], sums, strict=True)) for r in out if r.vec_id is not None)
    assert {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-9


def test_few_and_equal_vectors(spark):
    flat = spark.createDataFrame([(i, [0.25, 0.5], "a", "b") for i in range(5)], SCHEMA)
    assert whitening.whiten(flat).count() == 0
    assert whitening.whiten(flat.limit(0)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 1.0, -float(i)], "a", "b") for i in range(8)], SCHEMA)
    out = whitening.whiten(line).collect()
    assert len(out) == 8 and {r.component for r in out} == {1} and abs(out[0].explained - 1) < 1e-12
    assert abs(np.mean([r.whitened**2 for r in out]) - 1) < 1e-9


def test_deviation_beyond_a_long_is_null(spark):
    far = spark.createDataFrame([(1, [1e30], "", ""), (2, [-1e30], "", ""), (3, [0.0], "", "")], SCHEMA)
    out = {r.vec_id: r for r in whitening.whiten(far).collect()}
    assert out[1].deviation is None and out[3].deviation == 0
