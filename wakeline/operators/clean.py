"""Reading-side normalisation and the three point cleaners.

All cleaners are DataFrame -> DataFrame transforms over canonical column names
(``mmsi, ts, lat, lon, sog, cog, width, length, draught, shiptype``) and keep
any extra columns (e.g. a source row id ``rid``) untouched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators.medians import exact_medians
from wakeline.scratch import Scratch

# Header aliases of the reference readers (stripped header -> canonical).
ALIASES: dict[str, str] = {
    "# Timestamp": "ts", "Timestamp": "ts", "timestamp": "ts", "TimeStamp": "ts",
    "datetime": "ts", "time": "ts",
    "MMSI": "mmsi", "mmsi": "mmsi", "Mmsi": "mmsi",
    "Latitude": "lat", "latitude": "lat", "lat": "lat", "LAT": "lat",
    "Longitude": "lon", "longitude": "lon", "lon": "lon", "lng": "lon", "LON": "lon",
    "SOG": "sog", "sog": "sog", "speed": "sog",
    "COG": "cog", "cog": "cog", "course": "cog",
    "Width": "width", "width": "width",
    "Length": "length", "length": "length",
    "Draught": "draught", "draught": "draught", "draft": "draught",
    "Ship type": "shiptype", "Ship Type": "shiptype", "ship_type": "shiptype", "shiptype": "shiptype",
}
# Route-label column candidates, first present wins.
ROUTE_LABEL_CANDIDATES = ("Route", "route", "route_id", "route_label", "RouteLabel", "ROUTE")

REQUIRED = ("mmsi", "ts", "lat", "lon")
MEASURES = ("lat", "lon", "sog", "cog", "width", "length", "draught", "shiptype")
DIMENSIONS = ("width", "length", "draught")
KEEP = ("mmsi", "ts", "lat", "lon", "sog", "cog", "width", "length", "draught", "shiptype")
MMSI_MIN, MMSI_MAX = 100000000, 999999998
MAX_SOG_KN = 70.0


# ---------------------------------------------------------------- schema --

def normalize_columns(df: DataFrame, aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """Strip header whitespace/BOM and rename known variants to canonical names.

    Route-label candidates are renamed to ``route_label`` (first present wins).
    Raises if two raw columns land on the same canonical name.
    """

    targets: dict[str, str] = {}
    route_done = False
    for raw in df.columns:
        name = raw.replace("﻿", "").strip()
        if name in ROUTE_LABEL_CANDIDATES:
            if route_done:
                continue
            target, route_done = "route_label", True
        else:
            target = aliases.get(name, name)
        if target in targets.values():
            raise ValueError(f"columns map to the same name {target!r}: {list(df.columns)}")
        targets[raw] = target
    return df.select([F.col(f"`{raw}`").alias(t) for raw, t in targets.items()])


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def project_keep(df: DataFrame, keep: Sequence[str] = KEEP, extra: Sequence[str] = ("rid", "route_label")) -> DataFrame:
    """Keep known columns only (in canonical order), plus optional extras present."""

    return df.select([c for c in (*keep, *extra) if c in df.columns])


def add_missing_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add absent optional columns as typed nulls."""

    for name, dtype in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(dtype))
    return df


def _num(c: str) -> Column:
    """Column → double with bad text → null and NaN/inf → null."""

    x = F.expr(f"try_cast(`{c}` AS DOUBLE)")
    return F.when(F.isnan(x) | x.isin(float("inf"), float("-inf")), F.lit(None).cast("double")).otherwise(x)


def coerce_types(df: DataFrame, numeric: Sequence[str] = MEASURES, ts: str = "ts", mmsi: str = "mmsi") -> DataFrame:
    """Bad numbers / timestamps become null; ``mmsi`` is parsed numerically."""

    out = []
    for c in df.columns:
        dtype = dict(df.dtypes)[c]
        if c == ts:
            if dtype in ("timestamp", "timestamp_ntz"):
                out.append(F.col(c).cast("timestamp").alias(c))
            elif dtype == "string":
                out.append(F.expr(f"try_to_timestamp(trim(`{c}`))").cast("timestamp").alias(c))
            else:
                out.append(F.col(c).cast("timestamp").alias(c))
        elif c in numeric or c == mmsi:
            out.append(_num(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(out)


def null_out_of_range(df: DataFrame) -> DataFrame:
    """Null every value outside its physical range (row kept)."""

    def keep(c: str, cond: Column) -> Column:
        return F.when(cond, F.col(c)).alias(c)

    rules = {
        "mmsi": F.col("mmsi").between(MMSI_MIN, MMSI_MAX),
        "lat": F.col("lat").between(-90.0, 90.0),
        "lon": F.col("lon").between(-180.0, 180.0),
        "sog": F.col("sog").between(0.0, MAX_SOG_KN),
        "cog": F.col("cog").between(0.0, 360.0),
        **{d: F.col(d) >= 0 for d in DIMENSIONS},
    }
    return df.select([keep(c, rules[c]) if c in rules else F.col(c) for c in df.columns])


def drop_missing_keys(df: DataFrame, subset: Sequence[str] = REQUIRED) -> DataFrame:
    return df.na.drop(subset=[c for c in subset if c in df.columns])


def canonical_mmsi(df: DataFrame) -> DataFrame:
    return df.withColumn("mmsi", F.col("mmsi").cast("bigint"))


def dedup_points(
    df: DataFrame,
    keys: Sequence[str] = ("mmsi", "ts", "lat", "lon"),
    first_by: Sequence[str] | None = None,
) -> DataFrame:
    """Distinct on ``keys``; of each copy group the row first in ``first_by`` wins.

    ``first_by`` defaults to the source row id ``rid`` when present, else all
    other columns (a total order, so the result is deterministic). Written as
    a ``min_by`` aggregate: copies collapse map-side before the shuffle, so a
    huge copy group never reaches one task whole.
    """

    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    if first_by is None:
        first_by = ["rid"] if "rid" in df.columns else others
    pick = F.min_by(F.struct(*others), F.struct(*first_by)).alias("_first")
    agg = df.groupBy(*keys).agg(pick)
    return agg.select(*[F.col(k) for k in keys], "_first.*").select(df.columns)


def fill_constants(df: DataFrame, values: Mapping[str, float] | None = None) -> DataFrame:
    return df.na.fill(dict(values or {"sog": 0.0, "cog": 0.0}))


# ------------------------------------------------------------ imputation --

def _stacked(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, name, value) rows: one pass over the points for all columns."""

    items = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(key, F.explode(items).alias("_s")).select(key, "_s.name", "_s.value")


def group_medians(df: DataFrame, cols: Sequence[str], key: str = "mmsi") -> tuple[DataFrame, DataFrame]:
    """Exact per-key medians and the global median of the key-filled column.

    Returns ``(per_key, global_row)``: ``per_key`` has one row per key with
    ``<col>`` = median of that key's non-null values; ``global_row`` is one row
    with the median over all rows after nulls were filled with their key's
    median (rows of keys with no value excluded). Both come from one
    ``(key, column, value)`` count, a map-side combined aggregate: a key's
    median from its distinct values and their counts, the global one by
    ``exact_medians``, which gathers no column anywhere. The counts are written
    once, as three aggregates read them.
    """

    counts = Scratch(df.sparkSession, "medians").write(_value_counts(df, cols, key), "values")
    per = _medians_by_key(counts, key)
    # the key-filled distribution: the key's own values plus n_null copies of its median
    filled = counts.where(F.col("value").isNotNull()).select("name", "value", "n").unionByName(
        per.where(F.col("median").isNotNull() & (F.col("n_null") > 0)).select(
            "name", F.col("median").alias("value"), F.col("n_null").alias("n")
        )
    )
    return _wide_medians(per, key, cols), medians_row(df, exact_medians(filled), cols)


def key_medians(df: DataFrame, cols: Sequence[str], key: str = "mmsi") -> DataFrame:
    """The exact medians of every key, one row each: ``group_medians`` without
    the global ones, so no pass is made for them."""

    return _wide_medians(_medians_by_key(_value_counts(df, cols, key), key), key, cols)


def _value_counts(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    return _stacked(df, key, cols).groupBy(key, "name", "value").agg(F.count(F.lit(1)).alias("n"))


def _medians_by_key(counts: DataFrame, key: str) -> DataFrame:
    return counts.groupBy(key, "name").agg(
        F.percentile("value", 0.5, F.col("n")).alias("median"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
    )


def _wide_medians(per: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return per.groupBy(key).agg(*[F.max(F.when(F.col("name") == c, F.col("median"))).alias(c) for c in cols])


def medians_row(df: DataFrame, medians: dict[str, float], cols: Sequence[str]) -> DataFrame:
    """One row with the median of every column (null where there is none)."""

    schema = ", ".join(f"{c} double" for c in cols)
    return df.sparkSession.createDataFrame([tuple(medians.get(c) for c in cols)], schema)


def column_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The exact median of every column as one row."""

    counts = _stacked(df.withColumn("_all", F.lit(0)), "_all", cols).groupBy("name", "value").agg(F.count("*").alias("n"))
    return medians_row(df, exact_medians(counts), cols)


def impute_group_median(
    df: DataFrame,
    cols: Sequence[str] = ("width", "length", "draught", "shiptype"),
    key: str = "mmsi",
    default: float = 0.0,
) -> DataFrame:
    """null ← key median ← global median (of the key-filled column) ← ``default``."""

    per_key, global_row = group_medians(df, cols, key)
    pk = per_key.select(key, *[F.col(c).alias(f"_km_{c}") for c in cols])
    gl = global_row.select(*[F.col(c).alias(f"_gm_{c}") for c in cols])
    # global_row is exactly one row: a proven-size broadcast.
    joined = df.join(pk, key, "left").crossJoin(F.broadcast(gl))
    fixed = {
        c: F.coalesce(F.col(c).cast("double"), F.col(f"_km_{c}"), F.col(f"_gm_{c}"), F.lit(default)).alias(c)
        for c in cols
    }
    return joined.select([fixed.get(c, F.col(c)) for c in df.columns])


def impute_group_mean(df: DataFrame, cols: Sequence[str] = DIMENSIONS, key: str = "mmsi") -> DataFrame:
    """null ← key mean ← global mean of the key-filled column (may stay null)."""

    s = _stacked(df, key, cols)
    per = s.groupBy(key, "name").agg(
        F.sum("value").alias("sv"), F.count("value").alias("nv"), F.count("*").alias("n")
    )
    # after filling, a key with values contributes sv + (n - nv) * mean = n * mean
    glob = per.where(F.col("nv") > 0).groupBy("name").agg(
        (F.sum(F.col("sv") / F.col("nv") * F.col("n")) / F.sum("n")).alias("gmean")
    )
    km = per.where(F.col("nv") > 0).groupBy(key).agg(
        *[F.max(F.when(F.col("name") == c, F.col("sv") / F.col("nv"))).alias(f"_km_{c}") for c in cols]
    )
    gl = glob.agg(*[F.max(F.when(F.col("name") == c, F.col("gmean"))).alias(f"_gm_{c}") for c in cols])
    joined = df.join(km, key, "left").crossJoin(F.broadcast(gl))
    fixed = {c: F.coalesce(F.col(c), F.col(f"_km_{c}"), F.col(f"_gm_{c}")).alias(c) for c in cols}
    return joined.select([fixed.get(c, F.col(c)) for c in df.columns])


# -------------------------------------------------------------- cleaners --

def clean_points(df: DataFrame) -> DataFrame:
    """Route-path cleaner: coerce, null out-of-range, drop missing keys,
    dedup (first wins), add missing optional columns, median-impute the
    static fields, fill speed/course with 0 (S1, S2 kept). The distinct points
    are written once, as the medians and the imputation both read them."""

    df = project_keep(require_columns(df))
    df = coerce_types(df)
    df = null_out_of_range(df)
    df = drop_missing_keys(df)
    df = canonical_mmsi(df)
    df = Scratch(df.sparkSession, "clean").write(dedup_points(df), "distinct")
    df = add_missing_columns(df, {c: "double" for c in ("sog", "cog", "width", "length", "draught", "shiptype")})
    df = impute_group_median(df)
    return fill_constants(df)


def clean_points_hourly(df: DataFrame) -> DataFrame:
    """Hourly-path cleaner (before resampling): keys *and* speed/course must be
    present, dimensions mean-imputed before dedup (S4, S5)."""

    df = df.select([c for c in ("rid", "ts", "mmsi", "lat", "lon", "sog", "cog", *DIMENSIONS) if c in df.columns])
    df = require_columns(df)
    df = coerce_types(df)
    df = null_out_of_range(df)
    df = drop_missing_keys(df, ("ts", "mmsi", "lat", "lon", "sog", "cog"))
    df = canonical_mmsi(df)
    dims = [c for c in DIMENSIONS if c in df.columns]
    if dims:
        df = impute_group_mean(df, dims)
    return dedup_points(df, ("ts", "mmsi", "lat", "lon"))


def clean_points_forecast(df: DataFrame) -> DataFrame:
    """Forecast-path cleaner (S14): coordinates validated, keys required, no
    dedup and no MMSI / speed / course range check."""

    cols = [c for c in ("rid", "mmsi", "ts", "lat", "lon", "sog", "cog", *DIMENSIONS) if c in df.columns]
    df = require_columns(df.select(cols))
    df = add_missing_columns(df, {c: "double" for c in ("sog", "cog", *DIMENSIONS)})
    df = coerce_types(df, numeric=("lat", "lon", "sog", "cog", *DIMENSIONS))
    df = drop_missing_keys(df)
    df = df.where(F.col("lat").between(-90.0, 90.0) & F.col("lon").between(-180.0, 180.0))
    return canonical_mmsi(df)


def parse_bool(c) -> Column:
    """Text → boolean: true/1/yes/y/t are true; anything else, null included, false."""

    x = F.lower(F.trim(F.col(c).cast("string") if isinstance(c, str) else c.cast("string")))
    return F.coalesce(x.isin("true", "1", "yes", "y", "t"), F.lit(False))


def clean_number_text(c) -> Column:
    """Non-finite or blank → null, else the double value."""

    return _num(c) if isinstance(c, str) else c


def load_type_features(df: DataFrame, target: str = "shiptype", text_cols: Sequence[str] = ("navigationalstatus",)) -> DataFrame:
    """Ship-type rows: trimmed headers, numeric coercion except the target and
    text columns, target trimmed and rows without a target dropped (S3: the
    documented intent, not the ``"nan"`` class)."""

    df = df.select([F.col(f"`{c}`").alias(c.strip()) for c in df.columns])
    out = []
    for c in df.columns:
        if c == target or c in text_cols:
            out.append(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias(c))
        elif c in ("mmsi",):
            out.append(_num(c).cast("bigint").alias(c))
        else:
            out.append(_num(c).alias(c))
    return df.select(out).where(F.col(target).isNotNull())
