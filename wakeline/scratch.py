"""Intermediate tables of one job, written to the cluster's shared folder.

A written table cuts lineage without carrying Spark's size estimates from round
to round (a checkpointed plan keeps them, and joins multiply them), and it
survives the loss of any executor.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from wakeline.session import checkpoint_dir


class Scratch:
    """A private folder below ``spark.checkpoint.dir`` with numbered tables."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/wakeline-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write ``df`` as parquet (with writer ``options``) and return the table read back."""

        self._n += 1
        path = f"{self.root}/{self._n:04d}-{name}"
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that nothing reads any more."""

        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in frames:
            p = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            p.getFileSystem(conf).delete(p, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, what a job shuffled is deleted when the job has ended, so that
    of a row of jobs only one's shuffle is on disk at a time."""

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
