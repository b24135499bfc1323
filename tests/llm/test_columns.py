"""Extra columns whose names are those of helper columns."""

import pytest

from wakeline.llm import mixing, pii, quality, simhash

NAMES = ["base", "cands", "_email", "_row", "_size", "_c", "_k1", "size", "copy", "place", "key", "noise", "buckets", "text_hash", "c0", "c1", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(f"id{i}", f"w{i} some words mail a{i}@b.org" if i % 4 else None, "s", *[f"{n}{i}" for n in NAMES]) for i in range(12)]
    columns = ", ".join(f"`{c}` string" for c in ["doc_id", "text", "source", *NAMES])
    return spark.createDataFrame(rows, columns)


def steps(spark, docs):
    labels = spark.createDataFrame([("id1", 1, 0), ("id2", 0, 0)], "doc_id string, quality int, toxic int")
    return {"quality": quality.select(docs, labels), "simhash": simhash.deduplicate(docs), "pii": pii.redact(docs), "mix": mixing.mix(docs)}


def test_kept(spark, docs):
    given = {r.doc_id: r for r in docs.collect()}
    for name, out in steps(spark, docs).items():
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows, name
        for r in rows:
            want = given[r.doc_id]
            assert r.source == "s" and [r[n] for n in NAMES] == [want[n] for n in NAMES], name
            if name == "pii" and r.text:
                assert r.text == want.text.split(" mail ")[0] + " mail [EMAIL]"


def test_empty(spark, docs):
    for name, out in steps(spark, docs.limit(0)).items():
        assert out.columns == docs.columns and out.collect() == [], name
