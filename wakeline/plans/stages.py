"""Stage tables: intermediate results written once to the shared folder.

The cleaned points feed most operators (summaries, scans, stops, joins); at
scale they are written once as parquet under the cluster's
``spark.checkpoint.dir`` and every consumer reads them back with column
pruning and filter pushdown. This also cuts lineage: a lost executor costs a
re-read, not a re-run of the cleaning plan.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from wakeline.session import checkpoint_dir

TABLE = "events"  # the table that all stages are derived from
_code = ""
direct: set[str] = set()  # stages that are planned in place instead of written (bench.py)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return bool(p.getFileSystem(conf).exists(p))


def _code_tag() -> str:
    """Hash of this package's source, so a changed operator builds anew."""

    global _code
    if not _code:
        h = hashlib.sha1()
        root = Path(__file__).resolve().parents[1]
        for folder in ("functions", "operators", "plans", "sources"):
            for f in sorted((root / folder).glob("*.py")):
                h.update(f.read_bytes())
        _code = h.hexdigest()
    return _code


def source_tag(spark: SparkSession, source: str) -> str:
    """What identifies an input folder's events: its path and the name, size
    and modification time of every file of the table."""

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{source.rstrip('/')}/{TABLE}.parquet")
    fs = p.getFileSystem(conf)
    found = [f"{f.getPath().getName()}|{f.getLen()}|{f.getModificationTime()}" for f in fs.listStatus(p)] if fs.exists(p) else []
    return hashlib.sha1("\n".join([str(p), *sorted(found)]).encode()).hexdigest()[:16]


def stage_path(spark: SparkSession, name: str, source: str) -> str:
    tag = hashlib.sha1(f"{_code_tag()}|{source_tag(spark, source)}".encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/wakeline-stages/{name}-{tag}"


def stage_table(spark: SparkSession, name: str, source: str, build) -> DataFrame:
    """Return the stage ``name`` for ``source``; build and write it if absent.

    ``build`` is a zero-argument callable returning the DataFrame to stage. A
    stage is known by the files of its input and the package's code, so
    changed files or operators give a new one.
    """

    if name in direct:
        return build()
    path = stage_path(spark, name, source)
    if not _exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
