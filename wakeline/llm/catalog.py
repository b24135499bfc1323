"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import embeddings, html, licenses, merkle, mixing, negatives, pieces, pii, quality, secrets, simhash, urls, whitening
from wakeline.llm.oracles import OP1, OP2, OP4, OP7, OP12, OP13

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and representative of every vector."""

    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL["op1_embedding_near_dedup"] = OP1


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target, words taken and first training position of every document, in the
    order of training."""

    planned = mixing.in_order(mixing.plan(table(spark, sf_dir, "documents")))
    return planned.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "position")


SQL["op2_mix_sources"] = OP2


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""

    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""

    return secrets.report(table(spark, sf_dir, "documents"))


SQL["op4_secret_scan"] = OP4


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under merge-dropout and the hash of the text they
    decode to (equal to the document's own)."""

    model = pieces.read_model()
    encoded = pieces.encode(table(spark, sf_dir, "documents"), model)
    return pieces.decode(encoded, model, text_col="decoded").select(
        "doc_id", "n_ids", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how alike it
    is to that and to the next document."""

    return merkle.with_next(table(spark, sf_dir, "documents"))


URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for every page's url."""

    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


SQL["op7_url_filter"] = OP7


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""

    return html.extract(table(spark, sf_dir, "pages"))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""

    return pii.report(table(spark, sf_dir, "documents"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, noisy key and decision for every document."""

    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every sound vector."""

    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, base phrases and license labels of every document."""

    return licenses.report(table(spark, sf_dir, "documents"))


SQL["op12_license_scan"] = OP12


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive; each seventh label shifted."""

    vectors = table(spark, sf_dir, "embeddings")
    shifted = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    return negatives.mine(vectors.withColumn("label", shifted), "vec_id % 50 = 0")


SQL["op13_hard_negatives"] = OP13


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline over all documents."""

    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
