"""AIS-shaped tables derived from the driver's ``events`` table.

The reference ships no input data. These builders turn the given ``events``
rows into vessel position reports (and label / prediction rows) with integer
arithmetic up to the last division, so Spark and DuckDB produce bit-identical
doubles. Every builder is a plain projection plus one per-user min/max
aggregate, so its cost grows linearly with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (see FIXTURES.md §3).
EPOCH0_S = 1704067200          # 2024-01-01 00:00:00 UTC
CLOCK_SPEEDUP_US = 8000000     # 8x faster clock: 8 s of event time = 1 s of track time
MMSI_BASE = 219000000
SHIP_TYPES = ("Cargo", "Tanker", "Passenger", "Fishing")   # by user_id % 4
NAV_STATUS = {                                          # by event_type
    "view": "Under way using engine",
    "click": "Under way using engine",
    "purchase": "At anchor",
    "error": "Moored",
    "signup": "Engaged in fishing",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events_clock(events: DataFrame) -> DataFrame:
    t = F.expr(
        f"{EPOCH0_S} + div(unix_micros(CAST(ts AS TIMESTAMP)) - {EPOCH0_S}000000, {CLOCK_SPEEDUP_US})"
    )
    return events.select("event_id", "user_id", "event_type", "value", t.alias("t"))


def raw_points(events: DataFrame) -> DataFrame:
    """Events → raw AIS reports (canonical column names, invalid values kept).

    Columns: rid, mmsi, ts, lat, lon, sog, cog, heading, width, length,
    draught, shiptype (text), navigationalstatus, route_label.
    """

    e = _events_clock(events)
    span = e.groupBy("user_id").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    e = e.join(span, "user_id")
    eid, uid = F.col("event_id"), F.col("user_id")
    lane = uid % 6
    prog = F.expr("div((t - t0) * 1000, greatest(t1 - t0, 1))")
    e = e.withColumn("lane", lane).withColumn("prog", prog)
    qq = F.greatest(F.lit(0), F.least(F.lit(700), F.col("prog") - 150))
    lat_num = (
        F.lit(54000000) + F.col("lane") * 600000 + qq * (F.col("lane") % 3 - 1) * 1200
        + (eid * 7919) % 2001 - 1000
    )
    lon_num = (
        F.lit(8000000) + F.col("lane") * 900000
        + qq * F.when(F.col("lane") % 2 == 0, F.lit(3000)).otherwise(F.lit(-2500))
        + (eid * 104729) % 2001 - 1000
    )
    sog = (
        F.when(eid % 83 == 0, F.lit(None).cast("double"))
        .when((F.col("prog") < 150) | (F.col("prog") > 850), (eid % 10) / 10)
        .otherwise(F.col("value") / 4)
    )
    cog = ((eid * 37) % 3600) / 10
    dims_null = eid % 5 == 0
    type_idx = uid % 4
    nav = F.create_map(*[x for k, v in NAV_STATUS.items() for x in (F.lit(k), F.lit(v))])
    route = F.when(eid % 13 == 0, F.lit(None).cast("string")).otherwise(
        F.format_string("lane_%d", (F.col("lane") + F.when(eid % 11 == 0, 1).otherwise(0)) % 6)
    )
    return e.select(
        eid.alias("rid"),
        F.when(eid % 89 == 0, F.lit(0)).otherwise(F.lit(MMSI_BASE) + uid).cast("bigint").alias("mmsi"),
        F.timestamp_seconds("t").alias("ts"),
        F.when(eid % 97 == 0, F.lit(91.0)).otherwise(lat_num.cast("double") / 1000000).alias("lat"),
        (lon_num.cast("double") / 1000000).alias("lon"),
        sog.cast("double").alias("sog"),
        cog.cast("double").alias("cog"),
        F.pmod(cog + (eid % 7) - 3, F.lit(360.0)).alias("heading"),
        F.when(dims_null, F.lit(None)).otherwise(10.0 + type_idx * 6.0).cast("double").alias("width"),
        F.when(dims_null, F.lit(None)).otherwise(40.0 + type_idx * 45.0).cast("double").alias("length"),
        F.when(dims_null | (uid % 7 == 0), F.lit(None))
        .otherwise((30 + type_idx * 25) / 10).cast("double").alias("draught"),
        F.element_at(F.array(*[F.lit(s) for s in SHIP_TYPES]), (type_idx + 1).cast("int")).alias("shiptype"),
        F.coalesce(nav[F.col("event_type")], F.lit("Unknown")).alias("navigationalstatus"),
        route.alias("route_label"),
    )


COPY_RID_OFFSET = 1000000000000
NEIGHBOUR_RID_OFFSET = 2000000000000


def with_copies(points: DataFrame) -> DataFrame:
    """Append exact repeats and equal-time neighbours, as real feeds have them.

    Every 101st report is sent again later in the file (same key, speed
    +0.5 kn: the first copy must win the dedup); every 103rd gets a second
    report at the same time 0.002 deg further east. One pass: each row
    explodes into itself plus its optional copies.
    """

    rid = F.col("rid")
    cols = points.columns
    orig = F.struct(*[F.col(c) for c in cols])
    copy = F.struct(*[
        (rid + COPY_RID_OFFSET).alias(c) if c == "rid" else (F.col(c) + 0.5).alias(c) if c == "sog" else F.col(c)
        for c in cols
    ])
    neighbour = F.struct(*[
        (rid + NEIGHBOUR_RID_OFFSET).alias(c) if c == "rid" else (F.col(c) + 0.002).alias(c) if c == "lon" else F.col(c)
        for c in cols
    ])
    rows = F.filter(
        F.array(orig, F.when(rid % 101 == 0, copy), F.when(rid % 103 == 0, neighbour)),
        lambda x: x.isNotNull(),
    )
    return points.select(F.explode(rows).alias("_r")).select("_r.*")


def ais_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The point fixture: raw reports with repeats and equal-time neighbours."""

    return with_copies(raw_points(read_table(spark, sf_dir, "events")))


def raw_text_points(events: DataFrame) -> DataFrame:
    """The same reports as raw CSV-like text with reference-style header variants.

    Every value is a string; some are made unparsable so ``coerce_types`` has
    work to do: every 31st speed is ``"abc"``, every 37th timestamp is
    ``"not a date"``.
    """

    p = with_copies(raw_points(events))
    eid = F.col("rid")
    return p.select(
        F.col("rid").cast("string").alias("rid"),
        F.col("mmsi").cast("string").alias(" MMSI "),
        F.when(eid % 37 == 0, F.lit("not a date"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("# Timestamp"),
        F.col("lat").cast("string").alias("Latitude"),
        F.col("lon").cast("string").alias("lon"),
        F.when(eid % 31 == 0, F.lit("abc")).otherwise(F.col("sog").cast("string")).alias("SOG"),
        F.col("cog").cast("string").alias("course"),
        F.col("width").cast("string").alias("Width"),
        F.col("length").cast("string").alias("length"),
        F.col("draught").cast("string").alias("draft"),
        F.col("shiptype").alias("Ship type"),
        F.col("route_label").alias("Route"),
    )


def label_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label / prediction rows from ``events`` (FIXTURES.md §4).

    label = event_type; prediction = event_type except every 7th event takes
    the user's previous event type (or itself for the first); confidence =
    (event_id % 1000) / 1000; group = user_id.
    """

    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    # previous event of the same user: a bounded per-user lag, computed with the
    # bucketed scan so that no user is held in one task.
    from wakeline.operators.sequence import with_prev

    prev = with_prev(
        ev.withColumn("ts", F.col("ts").cast("timestamp")),
        ["event_type"],
        key="user_id",
        order=("ts", "event_id"),
    )
    pred = F.when(
        F.col("event_id") % 7 == 0, F.coalesce(F.col("prev_event_type"), F.col("event_type"))
    ).otherwise(F.col("event_type"))
    return prev.select(
        "event_id",
        F.col("user_id").alias("group_id"),
        F.col("event_type").alias("label"),
        pred.alias("prediction"),
        ((F.col("event_id") % 1000) / 1000).alias("confidence"),
    )
