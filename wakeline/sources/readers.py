"""Sources and sinks: CSV readers with header normalisation, multi-file
merge, timestamp formatting on write, run summaries and GeoJSON text."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wakeline.operators.clean import ALIASES, coerce_types, normalize_columns, project_keep, require_columns
from wakeline.scratch import Scratch

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"  # fixed value: the reference's sink format


def read_text_points(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every value as text, under canonical names; the known
    columns only."""

    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return project_keep(require_columns(normalize_columns(raw)))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """CSV (header, every value read as text) → canonical names, typed.

    No schema inference: parsing is one ``try_cast`` per column, so a bad
    value becomes null instead of failing the job or widening a type.
    """

    return coerce_types(read_text_points(spark, path))


def list_csv(spark: SparkSession, folder: str, exclude: str | None = None) -> list[str]:
    """The CSV files of ``folder``, and of a folder that Spark wrote there (its
    name also ending in .csv), without the output ``exclude``; in order of name."""

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    out = []
    for found in fs.listStatus(root):
        path = found.getPath()
        if not path.getName().endswith(".csv") or path.getName() == (exclude or "").rstrip("/").rsplit("/", 1)[-1]:
            continue
        inner = fs.listStatus(path) if found.isDirectory() else [found]
        out += [f.getPath().toString() for f in inner if f.getPath().getName().endswith(".csv") and f.getLen()]
    return sorted(out)


def header_index(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header. Only the first line of a file is read,
    several files at a time, so many files cost little and plan as few scans."""

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def header(path: str) -> tuple[str, ...]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(p.getFileSystem(conf).open(p), "UTF-8"))
        try:
            line = stream.readLine() or ""
        finally:
            stream.close()
        return tuple(next(csv.reader([line.lstrip("\ufeff")]), []))

    out: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for path, names in zip(files, pool.map(header, files), strict=True):
            out.setdefault(names, []).append(path)
    return out


def merge_frames(frames: Sequence[DataFrame], seen: Observation | None = None) -> DataFrame:
    """Union of sources by name (missing columns are null), keys coerced, rows
    without vessel or time dropped. ``seen`` gets ``rows`` and ``dropped_rows``
    of the pass that an action on the result makes."""

    out = None
    for f in frames:
        f = normalize_columns(f)
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    kinds = dict(out.dtypes)
    typed = out.selectExpr(
        *[f"`{c}`" for c in out.columns if c not in ("mmsi", "ts")],
        "try_cast(mmsi AS BIGINT) AS mmsi" if kinds.get("mmsi") != "string" else "try_cast(try_cast(trim(mmsi) AS DOUBLE) AS BIGINT) AS mmsi",
        "CAST(ts AS TIMESTAMP) AS ts" if kinds.get("ts") != "string" else "CAST(try_to_timestamp(trim(ts)) AS TIMESTAMP) AS ts",
    )
    bad = "mmsi IS NULL OR ts IS NULL"
    if seen is not None:
        typed = typed.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.expr(bad)).alias("dropped_rows"))
    return typed.where(f"NOT ({bad})")


def merge_sources(spark: SparkSession, folder: str, exclude: str | None = None, seen: Observation | None = None) -> DataFrame:
    """Every CSV of ``folder`` but the output ``exclude``, merged: one scan for
    each distinct header, all values as text but vessel and time. A file without
    a vessel or time column is an error that names it, and so is a folder without
    files. The rows are not ordered; ``write_merged`` orders them."""

    files = list_csv(spark, folder, exclude)
    if not files:
        raise FileNotFoundError(f"no CSV files in {folder}")
    frames = []
    for names, paths in header_index(spark, files).items():
        known = {ALIASES.get(n.strip()) for n in names}
        missing = [c for c in ("mmsi", "ts") if c not in known]
        if missing:
            raise ValueError(f"{paths[0]} has no column for {missing}")
        schema = StructType([StructField(n, StringType()) for n in names])
        frames.append(spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(paths))
    return merge_frames(frames, seen)


def write_merged(spark: SparkSession, folder: str, output: str) -> DataFrame:
    """Merge the CSV files of ``folder`` into the CSV table ``output``, ordered by
    vessel and time. Returns one row: files, total_rows, vessels, dropped_rows.

    The sources are parsed once, into a table in the shared folder, and counted in
    that pass; ordering samples its input first, so it reads the table."""

    seen, scratch = Observation("merge"), Scratch(spark, "merge")
    files = len(list_csv(spark, folder, output))
    merged = scratch.write(merge_sources(spark, folder, output, seen), "rows")
    counts = seen.get
    write_table(merged.repartitionByRange("mmsi", "ts").sortWithinPartitions("mmsi", "ts"), output, "csv")
    report = merged.agg(F.count_distinct("mmsi").alias("vessels")).first()["vessels"]
    scratch.drop(merged)
    row = (files, counts["rows"] - counts["dropped_rows"], report, counts["dropped_rows"])
    return spark.createDataFrame([row], "files long, total_rows long, vessels long, dropped_rows long")


def format_ts(df: DataFrame, cols: Sequence[str] = ("ts",)) -> DataFrame:
    """Timestamps → ``yyyy-MM-dd HH:mm:ss`` text for CSV sinks."""

    return df.selectExpr(*[f"date_format({c}, '{TS_FORMAT}') AS {c}" if c in cols else f"`{c}`" for c in df.columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Parquet by default (CSV with formatted timestamps on request)."""

    w = (format_ts(df, [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"])
         if fmt == "csv" else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_run_summary(summary: DataFrame, path: str) -> None:
    """A one-row summary DataFrame as a single JSON document."""

    summary.coalesce(1).write.mode("overwrite").json(path)


def geojson_feature_sql(geometry_type: str, coordinates: str, properties: Sequence[str]) -> str:
    """``to_json`` of a GeoJSON Feature built from columns (one per line)."""

    props = ", ".join(f"'{p}', {p}" for p in properties)
    return (
        f"to_json(named_struct('type', 'Feature', 'geometry', named_struct('type', '{geometry_type}',"
        f" 'coordinates', {coordinates}), 'properties', named_struct({props})))"
    )


def write_geojson_lines(features: DataFrame, column: str, path: str) -> None:
    """One Feature per line (GeoJSON text sequence); no driver collect."""

    features.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def resolve_column(df: DataFrame, name: str) -> str:
    """The column of ``df`` called ``name``, whatever its case (an exact match
    first); raises if there is none. Works on the plan, reads nothing."""

    found = [c for c in df.columns if c == name] or [c for c in df.columns if c.lower() == name.strip().lower()]
    if not found:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return found[0]


def load_side_table(spark: SparkSession, path: str, types: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """A CSV table with the columns and types of ``types``: what does not parse
    and what is missing becomes null, rows without all ``keys`` are dropped."""

    raw = spark.read.option("header", True).csv(path)
    typed = raw.selectExpr(*[
        f"try_cast(trim(`{c}`) AS {t}) AS {c}" if c in raw.columns else f"CAST(NULL AS {t}) AS {c}" for c, t in types.items()])
    return typed.na.drop(subset=list(keys))


METRICS_SCHEMA = (
    "model STRING, metrics STRUCT<accuracy: DOUBLE, macro_f1: DOUBLE, weighted_f1: DOUBLE>,"
    " leakage STRUCT<overlap_ratio: DOUBLE>, horizons ARRAY<STRUCT<horizon_h: INT, mean_error_km: DOUBLE>>"
)


def metric_summary(spark: SparkSession, path: str) -> DataFrame:
    """One row per model from nested metric JSON: accuracy, F1, leakage, and the
    mean of the horizons' errors (null where a model has none)."""

    return spark.read.schema(METRICS_SCHEMA).json(path).selectExpr(
        "model", "metrics.accuracy", "coalesce(metrics.macro_f1, metrics.weighted_f1) AS f1", "leakage.overlap_ratio",
        "aggregate(coalesce(horizons, array()), named_struct('s', 0D, 'n', 0), (a, h) -> named_struct('s', a.s + h.mean_error_km, 'n', a.n + 1),"
        " a -> CASE WHEN a.n > 0 THEN a.s / a.n END) AS mean_error_km")
