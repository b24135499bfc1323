"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import mixing, pieces, pii, quality, simhash
from wakeline.scratch import Scratch


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance-resampling classifier keeps; its target is
    fitted on the documents labelled good."""

    return quality.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (3-word shingles, 3 bits)."""

    return simhash.deduplicate(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""

    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, in the order of training."""

    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids under seeded merge-dropout: doc_id, ids, n_ids."""

    return pieces.encode(docs, pieces.read_model())


STAGES = [
    ("quality_classifier", classify),
    ("simhash_near_dedup", deduplicate),
    ("pii", redact),
    ("mix_sources", mix),
    ("sentencepiece", encode),
]

#: DuckDB has neither the classifier nor the tokenizer; tests/llm/test_pipeline.py
#: holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table, each one's rows written and
    read again as the next one's."""

    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
