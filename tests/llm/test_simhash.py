"""SimHash near-dedup against brute force."""

import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm import simhash
from wakeline.llm.bktree import Forest


def slow_fingerprint(text, shingle=3):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i: i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows):
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    fps = [slow_fingerprint(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                up[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        r = find(i)
        low[r] = k if low.get(r) is None else low[r] if k is None else min(low[r], k)
    return sorted(((k, fps[i], low[find(i)]) for i, (k, _) in enumerate(rows)), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbÉ \t\x1c\n \x0b", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_matches_spark_hash(spark):
    words = ["eins", "zwei", "drei", "vier"]
    got = spark.sql("SELECT xxhash64('eins zwei drei') AS h").first().h % (1 << 64)
    assert simhash.fingerprint(" ".join(words[:3])) == got


def test_forest_finds_every_neighbour():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    pts = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40), base ^ np.uint64(0b11110)]))
    group = np.sort(rng.integers(0, 3, len(pts)))
    f = Forest(pts, group)
    root = np.array([f.roots[g] for g in group.tolist()])
    q, p = f.search(pts, root, 3)
    got = set(zip(q.tolist(), p.tolist(), strict=True))
    want = {(i, j) for i in range(len(pts)) for j in range(len(pts))
            if group[i] == group[j] and int(pts[i] ^ pts[j]).bit_count() <= 3}
    assert got == want


def test_near_duplicates(spark):
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    base = [" ".join(rnd.choices(vocab, k=rnd.randint(1, 160))) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    for t in base[:12]:  # exact copies and near copies
        rows.append((len(rows), t.upper()))
        w = t.split()
        w[rnd.randrange(len(w))] = "zz"
        rows.append((len(rows), "  " + "\t".join(w)))
    rows += [(100, None), (101, ""), (102, " \n"), (None, "lost"), (103, "lost"), (3, base[3]), (104, "x " * 30000)]
    docs = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "doc_id long, text string, fp string, component_id int")
    for shard_rows in (4096, 2):  # 2: nearly every shard is dealt into several trees
        out = simhash.near_duplicates(docs, shard_rows=shard_rows)
        got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in out.collect()), key=repr)
        assert got == slow_components(rows)


def test_links_in_dealt_shards(spark):
    rnd = random.Random(9)
    centre = rnd.getrandbits(63)
    pts = list({centre ^ (1 << rnd.randrange(63)) ^ (1 << rnd.randrange(63)) ^ (1 << rnd.randrange(63)) for _ in range(300)})
    fps = spark.createDataFrame([(p,) for p in pts], "fp long")
    from wakeline.operators.components import connected_components

    got = {r.node: r.root for r in connected_components(spark, simhash.links(fps, shard_rows=16)).collect()}
    for a in pts:
        for b in pts:
            if 0 < (a ^ b).bit_count() <= 3:
                assert got[a] == got[b]


def test_deduplicate_keeps_one_row_each(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "A B C D"), (3, "other words here now"), (None, None), (4, ""),
            (None, "lost one"), (None, "LOST one"), (None, "lost two"), (1, "the id again")]
    out = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id for r in out), key=str) == [1, 1, 3, 4, None, None]
    assert sum(r.text == "a b c d" for r in out) == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.deduplicate(empty).collect() == [] and simhash.near_duplicates(empty).collect() == []
