"""Merkle fingerprints against a plain version over the whole table."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm import merkle

SCHEMA = "doc_id long, text string, fingerprint string"


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n\té", max_size=40), st.text(alphabet="ab \n\té", max_size=40))
def test_roots(a, b):
    fa, fb = merkle.fingerprint(a), merkle.fingerprint(b)
    assert (fa == fb) == (a == b)
    assert 0 <= merkle.likeness(fa, fb) <= 1 and merkle.likeness(fa, fb) == merkle.likeness(fb, fa)
    assert merkle.likeness(fa, fa) == 1
    assert b"".join(x for _, ps in [merkle.tree(a)] for s in ps for _, ls in s for x in ls) is not None


def test_leaves_lose_nothing():
    for t in ("", " a  b\tc d e f ", "x" * 5000, "   ", "a b c d e f g h i"):
        assert "".join(merkle._LEAF.findall(t)) == t


def test_likeness_of_long_texts():
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(9999)}" for _ in range(20000)]
    half = words[:10000] + [f"v{rnd.randrange(9999)}" for _ in range(10000)]
    a, b, c = (merkle.fingerprint(" ".join(w)) for w in (words, half, [x + "q" for x in words]))
    assert abs(merkle.likeness(a, b) - 0.5) < 0.15 and merkle.likeness(a, c) < 0.05


def plain(rows):
    def spark_order(r):
        return (r[0] is not None, r[0] or 0)

    rows = sorted(rows, key=spark_order)
    out = []
    for i, (k, t, _) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(t)
        edited = t[: n - n // 2] + nxt[: n // 2]
        f, g, h = merkle.fingerprint(t), merkle.fingerprint(edited), merkle.fingerprint(nxt)
        out.append((k, n, hashlib.sha256(edited.encode()).hexdigest(), f, g, merkle.likeness(f, g), merkle.likeness(f, h)))
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 400])
def test_with_next(spark, n):
    rnd = random.Random(n)
    ids = rnd.sample(range(-500, 5000), n)
    rows = [(i, rnd.choice(["a b c\n\nd e", "é🎉 " * rnd.randint(1, 90), "", None, " ".join(rnd.choices("xyz", k=rnd.randint(1, 200)))]), "clash") for i in ids]
    if n == 400:
        rows += [(None, "a null id", "c"), (9999, "long " * 40000, "c"), (ids[0], rows[0][1], "c")]
    got = merkle.with_next(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain(rows)))


def test_edits(spark):
    old = spark.createDataFrame([(1, "a\nb\n\nc\nd"), (2, "same\ntext"), (3, "x")], "doc_id long, text string")
    new = spark.createDataFrame([(1, "a\nB\n\nc\nd\ne"), (2, "same\ntext"), (4, "y")], "doc_id long, text string")
    got = sorted(map(tuple, merkle.edits(old, new).collect()))
    assert got == [(1, 0, 1, "changed"), (1, 1, 2, "added"), (3, 0, 0, "removed"), (4, 0, 0, "added")]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n", max_size=60), st.text(alphabet="ab \n", max_size=60))
def test_common_leaves(a, b):
    from collections import Counter

    trees = [merkle.tree(t)[1] for t in (a, b)]
    x, y = (Counter(h for s in t for _, ls in s for h in ls) for t in trees)
    assert merkle.common_leaves(*trees) == sum((x & y).values())


def test_likeness_of_long_texts_is_exact(spark):
    # 2,000 leaves each; half, a third and 8 (0.4 %) of them shared
    paragraph = lambda k, i: " ".join(f"{k}{i}w{j}" for j in range(8))
    text = lambda k, shared: "\n".join([paragraph("s", i) for i in range(shared)] + [paragraph(k, i) for i in range(shared, 1000)])
    for shared in (500, 333, 4):
        docs = spark.createDataFrame([(1, text("a", shared)), (2, text("b", shared))], "doc_id long, text string")
        assert [r.near_next for r in merkle.with_next(docs).collect()] == [shared / 1000] * 2
