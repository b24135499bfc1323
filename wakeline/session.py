"""Spark session defaults and the shared checkpoint folder.

Everything in the library takes a ``SparkSession``; this module only offers a
builder with the settings the operators assume (UTC session zone, AQE with
skew-join splitting, no UI) and the rule for where lineage is cut.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "wakeline",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the settings the operators rely on.

    ``master`` and ``shuffle_partitions`` are set only when given, so what
    ``spark-submit`` or ``spark-defaults`` say stands. On a cluster size
    ``shuffle_partitions`` to roughly input bytes / 128 MB; adaptive execution
    can lower that number, not raise it.
    """

    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    }
    if os.environ.get("SPARK_DRIVER_MEMORY"):
        conf["spark.driver.memory"] = os.environ["SPARK_DRIVER_MEMORY"]
    elif master is not None and master.startswith("local"):
        conf["spark.driver.memory"] = "16g"  # local mode: the driver is the executor
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stage tables.

    The cluster names it in ``spark.checkpoint.dir``; that value is always
    used. Where it is unset, a local master gets a fresh folder (tests); any
    other master raises, since a machine-local folder is not visible to the
    other executors.
    """

    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="wakeline-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
