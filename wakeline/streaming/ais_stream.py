"""Structured Streaming versions of the streaming-capable operators.

``hourly_resample`` and ``stop_events`` are windowed aggregates (``window`` /
``session_window``) with a watermark: reports later than it still land in their
hour or stop, state behind it is evicted. ``null_out_of_range`` is a per-row
projection and streams unchanged.

``run_available_now`` drives a stream over what has arrived. Its sink is a folder
per micro-batch that a repeated batch replaces, and the query's checkpoint names
the batch to repeat, so a batch that was killed half-way is in the table once.
Hours are written in update mode, and of an hour's versions the latest batch's
counts (``latest``). Stops end with a silence, so they are written once, when the
watermark has passed it (append mode); ``with_open_stops`` adds those still open,
from the points after each vessel's last finished stop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.clean import null_out_of_range
from wakeline.session import checkpoint_dir

MEASURES = ("lat", "lon", "sog", "cog", "width", "length", "draught")


def read_point_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files arriving in ``path`` as a stream (schema pinned). With
    ``max_files`` a batch; files should then come in the order of time, as rows
    behind the watermark are dropped."""

    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def hourly_resample_stream(points: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Per vessel and hour: mean of each measure (valid keys only)."""

    p = null_out_of_range(points).where("mmsi IS NOT NULL AND ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
    p = p.withColumn("mmsi", F.col("mmsi").cast("bigint"))
    return p.withWatermark("ts", watermark).groupBy("mmsi", F.window("ts", "1 hour")).agg(
        *[F.avg(c).alias(c) for c in MEASURES if c in points.columns]
    ).selectExpr("mmsi", "window.start AS ts", *[c for c in MEASURES if c in points.columns])


def stop_events_stream(points: DataFrame, slow_sog: float = 1.0, gap_hours: float = 3.0,
                       watermark: str = "6 hours") -> DataFrame:
    """Slow-point sessions per vessel (gap > ``gap_hours`` splits)."""

    slow = points.where(F.col("sog") <= F.lit(float(slow_sog)))
    return _stops(slow.withWatermark("ts", watermark), int(round(gap_hours * 3600)))


def _stops(slow: DataFrame, gap_s: int) -> DataFrame:
    return slow.groupBy("mmsi", F.session_window("ts", f"{gap_s} seconds").alias("s")).agg(
        F.expr("min(ts) AS start_timestamp"), F.expr("max(ts) AS end_timestamp"), F.expr("count(1) AS point_count"),
        F.expr("avg(lat) AS center_lat"), F.expr("avg(lon) AS center_lon"), F.expr("avg(sog) AS mean_sog"),
    ).drop("s")


def with_open_stops(closed: DataFrame, points: DataFrame, slow_sog: float = 1.0, gap_hours: float = 3.0) -> DataFrame:
    """Finished stops and those that the watermark has not passed yet: the
    sessions of each vessel's slow points after its last finished stop."""

    done = closed.groupBy("mmsi").agg(F.max("end_timestamp").alias("_done"))
    rest = points.join(done, "mmsi", "left").where("_done IS NULL OR ts > _done").drop("_done")
    gap_s = int(round(gap_hours * 3600))
    return closed.unionByName(_stops(rest.where(F.col("sog") <= F.lit(float(slow_sog))), gap_s))


def _write_epoch(batch: DataFrame, epoch: int, out: str) -> None:
    batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")


def run_available_now(agg: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drive ``agg`` over everything that has arrived since the last run under
    this ``name`` and return the table of all batches, with their ``epoch``.

    The name stands for one source and one query: their checkpoint lies beside
    the table in the shared folder.
    """

    spark = agg.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/wakeline-streams/{name}"
    out = f"{base}/table"
    q = (agg.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True)
         .foreachBatch(lambda batch, epoch: _write_epoch(batch, epoch, out)).start())
    q.awaitTermination()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)  # nothing may have arrived yet
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in agg.schema.fields)
    return spark.read.schema(f"{kind}, epoch long").option("basePath", out).parquet(out)


def latest(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of all versions of a key the one of the latest batch."""

    rest = [c for c in table.columns if c not in (*keys, "epoch")]
    row = F.struct(*rest)
    return table.groupBy(*keys).agg(F.max_by(row, "epoch").alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])
