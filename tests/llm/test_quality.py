"""Quality classifier: brute force, exact selection, and accuracy on labels held out."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wakeline.llm import quality


def corpus(n=1500):
    rnd = random.Random(3)
    good = ["the", "of", "and", "water", "stone", "light", "house", "green", "walk", "slow"] + [f"word{i}" for i in range(150)]
    rows, truth = [], {}
    for i in range(n):
        words = rnd.choices(good, k=rnd.randint(20, 120))
        kind = rnd.choices(["good", "shout", "toxic"], [8, 1, 1])[0]
        if kind == "shout":
            words = [w.upper() + "!!" for w in words]
        if kind == "toxic":
            for _ in range(6):
                words[rnd.randrange(len(words))] = rnd.choice(["slurone", "slurtwo"])
        rows.append((i, " ".join(words), "x"))
        truth[i] = kind
    return rows, truth


def test_held_out(spark):
    rows, truth = corpus()
    labels = [(i, 0 if truth[i] == "shout" else 1, 1 if truth[i] == "toxic" else 0) for i in range(0, 1500, 2)]
    odd = [(9001, None, "x"), (9002, "", "x"), (None, "the of and water", "x"), (3, rows[3][1], "x"), (9003, "word1 " * 30000, "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, kept string")
    lab = spark.createDataFrame(labels + [(None, 1, 0), (1, None, None), (9001, 1, None)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, lab).collect()
    assert len(out) == len(rows) + len(odd)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 1500 and r.doc_id % 2]
    kept = {k: [r.kept for r in held if truth[r.doc_id] == k] for k in ("good", "shout", "toxic")}
    assert sum(kept["good"]) > 0.97 * len(kept["good"])
    assert sum(kept["shout"]) < 0.1 * len(kept["shout"]) and sum(kept["toxic"]) < 0.25 * len(kept["toxic"])
    three = [r for r in out if r.doc_id == 3]
    assert len(three) == 2 and three[0] == three[1]
    chosen = quality.select(docs, lab)
    assert chosen.columns == docs.columns
    assert sorted(str(r.doc_id) for r in chosen.collect()) == sorted(str(r.doc_id) for r in out if r.kept)


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in quality.classify(docs, lab).collect())
    some = spark.createDataFrame([(1, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.classify(docs.limit(0), some).collect() == []


def test_kth_largest(spark):
    rnd = random.Random(1)
    xs = [rnd.choice([0.0, -1.5, 1e300, -1e300, 5e-324, rnd.random()]) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in xs], "noisy_key double")
    for k in (1, 7, 150, 299):
        assert quality.kth_largest(df, k) == sorted(xs, reverse=True)[k - 1]
    assert quality.kth_largest(df, 300) == float("-inf")
    assert df.select(F.col("noisy_key")).count() == 300


def slow(rows, labels, keys, seed=quality.SEED):
    """Weights, noisy keys and chosen places by the docstring, with sets and dicts."""

    mask = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    def grams(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        cores, shapes = [], []
        for i, w in enumerate(words):
            core = re.sub(r"^[\W_]+|[\W_]+$", "", w) or w
            cores.append(xxhash.xxh64_intdigest(core.lower(), 1))
            shape = "".join(k for k, _ in itertools.groupby(
                "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in w))
            shapes.append(0x5EED if i and words[i - 1] == w else xxhash.xxh64_intdigest(shape, 2))
        word, shape, pair, two = quality.BITS
        return ({("w", h >> 64 - word) for h in cores} | {("s", mix(h) >> 64 - shape) for h in shapes}
                | {("p", mix((a * 3 + b) & mask) >> 64 - pair) for a, b in itertools.pairwise(shapes)}
                | {("b", mix((a * 3 + b) & mask) >> 64 - two) for a, b in itertools.pairwise(cores)})

    each = [grams(t) for _, t, *_ in rows]
    verdicts = {}
    for i, q, t in labels:
        if None not in (i, q, t):
            verdicts[i] = verdicts.get(i, True) and q == 1 and t == 0
    raw = Counter(g for x in each for g in x)
    target = Counter(g for (i, *_), x in zip(rows, each, strict=True) if verdicts.get(i) for g in x)
    rate = float(np.median(np.repeat([target[g] / n for g, n in raw.items()], list(raw.values()))))
    rate = rate or sum(target.values()) / sum(raw.values())
    ratio = {}
    for g, n in raw.items():
        expected = n * rate + 1
        log = math.log((target[g] + 1) / expected)
        ratio[g] = math.copysign(max(abs(log) - quality.DOUBT / math.sqrt(expected), 0), log)
    weights = [sum(ratio[g] for g in x) for x in each]
    noise = []
    for (_, t, *_), key in zip(rows, keys, strict=True):
        u = (mix(((key & mask) * 2 + seed) & mask) ^ xxhash.xxh64_intdigest(t or "", seed)) >> 11
        noise.append(-math.log(-math.log((u + 0.5) / 2**53)))
    noisy = [a + b for a, b in zip(weights, noise, strict=True)]
    share = sum(verdicts.values()) / len(verdicts)
    k = min(len(rows), math.ceil(len(rows) * (share + quality.MARGIN * math.sqrt(share * (1 - share) / len(verdicts)))))
    return weights, noisy, sorted(noisy, reverse=True)[k - 1]


@pytest.mark.parametrize("text_ids", [False, True])
def test_brute_force(spark, text_ids):
    rows, truth = corpus(500)
    odd = [(9001, None, "x"), (9002, "", "x"), (None, "the of and water", "x"), (9003, "word1 " * 30000, "x"), (9004, "-- (a-b) É1É 🎉🎉 ..", "x")]
    labels = [(i, int(truth[i] != "shout"), int(truth[i] == "toxic")) for i in range(0, 500, 2)] + [(None, 1, 0), (4, 0, 0), (9001, 1, None)]
    name = (lambda i: None if i is None else f"id-{i}") if text_ids else (lambda i: i)
    rows = [(name(i), *r) for i, *r in rows + odd]
    labels = [(name(i), *r) for i, *r in labels]
    kind = "string" if text_ids else "long"
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string, buckets string")
    lab = spark.createDataFrame(labels, f"doc_id {kind}, quality int, toxic int")
    keys = {r.doc_id: r.k for r in docs.select("doc_id", F.xxhash64("doc_id").alias("k")).collect()}
    weights, noisy, least = slow(rows, labels, [keys[r[0]] for r in rows])
    got = {r.doc_id: r for r in quality.classify(docs, lab).collect()}
    for row, w, x in zip(rows, weights, noisy, strict=True):
        assert got[row[0]].log_weight == pytest.approx(w, abs=1e-6) and got[row[0]].noisy_key == pytest.approx(x, abs=1e-6)
        assert got[row[0]].kept == (x >= least - 1e-9)
    chosen = quality.select(docs, lab)
    assert chosen.columns == docs.columns
    assert sorted(map(str, chosen.collect())) == sorted(str(r) for r in docs.collect() if got[r.doc_id].kept)
