"""The pipeline's stages against plain versions, one after the other."""

import random
import re

import corpus_pipeline
import pytest
from test_mixing import plain as plain_mix
from test_pii import slow as slow_pii
from test_quality import corpus
from test_simhash import slow_components

from wakeline.llm import pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(5)
    rows, truth = corpus(700)
    rows = [(i, t) for i, t, _ in rows]
    rows += [(2000 + k, rows[k][1]) for k in range(0, 60, 2)]  # exact copies
    rows += [(3000 + k, rows[k][1] + f" mail a{k}@b{k}.org or +1 555 010 {1000 + k}, ip 10.0.0.{k}") for k in range(1, 90, 3)]
    rows += [(4000, None), (4001, ""), (4002, "the of and water"), (4002, "the of and water")]
    docs = [(i, t, "en", f"s{rnd.randrange(4)}" if i % 5 else "hot", len(t or "")) for i, t in rows]
    # as in the given tables, labels cover rows of every kind, copies included
    kind = {i: truth.get(i if i < 2000 else i % 1000) for i, _ in rows if i < 4000}
    labels = [(i, 0 if k == "shout" else 1, 1 if k == "toxic" else 0) for n, (i, k) in enumerate(kind.items()) if n % 2 == 0]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, truth


def test_stages(spark, folder, tmp_path):
    path, truth = folder
    seen = {"documents": spark.read.parquet(f"{path}/documents.parquet")}
    last = seen["documents"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, last, path).write.parquet(f"{tmp_path}/{k}")
        last = seen[name] = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or last.columns == COLUMNS
    rows = {n: [tuple(r) for r in df.collect()] for n, df in seen.items()}

    good = [r for r in rows["documents"] if truth.get(r[0]) == "good"]
    kept = {r[0] for r in rows["quality_classifier"]}
    assert set(rows["quality_classifier"]) <= set(rows["documents"])
    assert sum(r[0] in kept for r in good) > 0.97 * len(good)
    assert sum(truth[i] != "good" for i in kept if i in truth) < 0.25 * sum(x != "good" for x in truth.values())

    groups = {}
    for i, _, low in slow_components([(r[0], r[1]) for r in rows["quality_classifier"]]):
        groups.setdefault(low, set()).add(i)
    assert sorted(r[0] for r in rows["simhash_near_dedup"]) == sorted(groups)
    assert set(rows["simhash_near_dedup"]) <= set(rows["quality_classifier"])

    def redacted(t):
        for _, a, b, kind in sorted(slow_pii(t), key=lambda s: -s[1]):
            t = t[:a] + f"[{kind.upper()}]" + t[b:]
        return t

    want = {r[0]: redacted(r[1]) for r in rows["simhash_near_dedup"] if r[1] is not None}
    for r in rows["pii"]:
        assert r[1] == want.get(r[0]) and r[4] == (len(r[1]) if r[1] is not None else None), r[0]
    assert len(rows["pii"]) == len(rows["simhash_near_dedup"])

    plan, target = plain_mix([(r[0], r[1], r[3], "") for r in rows["pii"]])
    taken = {}
    for r in rows["mix_sources"]:
        taken[r[0]] = taken.get(r[0], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    assert taken == {k: n for _, k, _, _, _, n in plan if n}

    own = pieces.Pieces(pieces.read_model())
    texts = sorted((r[0], r[1]) for r in rows["mix_sources"])
    assert sorted((i, own.decode(ids)) for i, ids, _ in rows["sentencepiece"]) == texts


def test_run_is_the_stages(spark, folder):
    path, _ = folder
    a, b = (sorted((r.doc_id, tuple(r.ids), r.n_ids) for r in corpus_pipeline.run(spark, path).collect()) for _ in range(2))
    assert a == b and len(a) > 300
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "pii", "mix_sources", "sentencepiece"]


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
