"""Per-track sequence scans that never hold one track in one task.

Window functions partitioned by vessel alone put a whole track into one task;
a vessel (or user) holding a third of all rows would then serialise the job.
Every per-track scan here instead partitions by ``(key, time bucket)``
(default one day, which physically bounds a vessel's reports), runs the
window inside the bucket, and stitches buckets together through a small
per-bucket table (one row per key and bucket):

* ``prev_*``: the previous row's values; the first row of a bucket takes the
  last row of the nearest earlier non-empty bucket.
* ``next_*``: the same in the other direction.
* running sums / row index: the in-bucket running sum plus the sum of all
  earlier buckets' totals.

The per-bucket table is built by a partial (map-side combined) aggregate on
the input, so the points are shuffled exactly once per scan, on
``(key, bucket)``, and the stitching join reuses that partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_SECONDS = 86400
_B = "_wl_bucket"


def order_for(df: DataFrame) -> tuple[str, ...]:
    """Canonical track order: time, position, then the source row id if any
    (cleaned points are unique on (mmsi, ts, lat, lon); raw ones may repeat)."""

    return ("ts", "lat", "lon", "rid") if "rid" in df.columns else ("ts", "lat", "lon")


def bucket_col(ts: str = "ts", bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> Column:
    return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / F.lit(bucket_seconds)).cast("bigint")


def track_scan(
    df: DataFrame,
    *,
    key: str | Sequence[str] = "mmsi",
    order: Sequence[str] = ("ts", "lat", "lon"),
    ts: str = "ts",
    prev: Iterable[str] = (),
    next: Iterable[str] = (),
    cumsum: Mapping[str, str] | None = None,
    index: str | None = None,
    track_first: Iterable[str] = (),
    track_last: Iterable[str] = (),
    track_count: str | None = None,
    ffill: Iterable[str] = (),
    bfill: Iterable[str] = (),
    prev_prefix: str = "prev_",
    next_prefix: str = "next_",
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Add lag / lead / running-sum / row-index columns per track in one pass.

    ``order`` must be a total order within a track for deterministic results.
    ``cumsum`` maps output names to numeric SQL expressions over the row; the
    output is the inclusive running sum in ``order``. ``index`` names a
    0-based row number per track.
    """

    keys = [key] if isinstance(key, str) else list(key)
    prev, next = list(prev), list(next)
    track_first, track_last = list(track_first), list(track_last)
    ffill, bfill = list(ffill), list(bfill)
    sums = {k: v for k, v in (cumsum or {}).items()}
    if index:
        sums[index] = "1"
    ks = ", ".join(f"`{k}`" for k in keys)
    order_s = ", ".join(f"`{c}`" for c in order)
    ok = f"struct({order_s})"

    def st(cols: list[str]) -> str:
        return "struct(" + ", ".join(f"`{c}`" for c in cols) + ")"

    base = df.selectExpr(
        "*",
        f"CAST(floor(unix_seconds(CAST(`{ts}` AS TIMESTAMP)) / {int(bucket_seconds)}) AS BIGINT) AS {_B}",
        *[f"{_sql(v)} AS `_wl_v_{n}`" for n, v in sums.items()],
    )

    # Small per-bucket table: last / first row values and bucket totals.
    aggs = []
    if prev:
        aggs.append(f"max_by({st(prev)}, {ok}) AS _wl_last")
    if next:
        aggs.append(f"min_by({st(next)}, {ok}) AS _wl_first")
    if track_first:
        aggs.append(f"min_by({st(track_first)}, {ok}) AS _wl_bfirst")
    if track_last:
        aggs.append(f"max_by({st(track_last)}, {ok}) AS _wl_blast")
    if track_count:
        aggs.append("count(1) AS _wl_bcount")
    aggs += [f"sum(`_wl_v_{n}`) AS `_wl_tot_{n}`" for n in sums]
    aggs += [f"max_by(`{c}`, {ok}) FILTER (WHERE `{c}` IS NOT NULL) AS `_wl_fl_{c}`" for c in ffill]
    aggs += [f"min_by(`{c}`, {ok}) FILTER (WHERE `{c}` IS NOT NULL) AS `_wl_bf_{c}`" for c in bfill]
    per_bucket = base.groupBy(*keys, _B).agg(*[F.expr(a) for a in aggs])
    wb = f"(PARTITION BY {ks} ORDER BY {_B})"
    wb_all = f"(PARTITION BY {ks} ORDER BY {_B} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    stitched = []
    if prev:
        stitched.append(f"lag(_wl_last) OVER {wb} AS _wl_plast")
    if next:
        stitched.append(f"lead(_wl_first) OVER {wb} AS _wl_nfirst")
    stitched += [
        f"coalesce(sum(`_wl_tot_{n}`) OVER (PARTITION BY {ks} ORDER BY {_B} ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND 1 PRECEDING), 0) AS `_wl_off_{n}`"
        for n in sums
    ]
    stitched += [
        f"last(`_wl_fl_{c}`, true) OVER (PARTITION BY {ks} ORDER BY {_B} ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND 1 PRECEDING) AS `_wl_pfl_{c}`"
        for c in ffill
    ]
    stitched += [
        f"last(`_wl_bf_{c}`, true) OVER (PARTITION BY {ks} ORDER BY {_B} DESC ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND 1 PRECEDING) AS `_wl_nbf_{c}`"
        for c in bfill
    ]
    if track_first:
        stitched.append(f"first(_wl_bfirst) OVER {wb_all} AS _wl_tfirst")
    if track_last:
        stitched.append(f"last(_wl_blast) OVER {wb_all} AS _wl_tlast")
    if track_count:
        stitched.append(f"sum(_wl_bcount) OVER {wb_all} AS _wl_tcount")
    per_bucket = per_bucket.selectExpr(*keys, _B, *stitched)

    # In-bucket window.
    w = f"(PARTITION BY {ks}, {_B} ORDER BY {order_s})"
    in_bucket = [f"lag(`{c}`) OVER {w} AS `_wl_p_{c}`" for c in prev]
    in_bucket += [f"lead(`{c}`) OVER {w} AS `_wl_n_{c}`" for c in next]
    if prev:
        in_bucket.append(f"row_number() OVER {w} = 1 AS _wl_is_first")
    if next:
        in_bucket.append(f"lead(1) OVER {w} IS NULL AS _wl_is_last")
    in_bucket += [
        f"sum(`_wl_v_{n}`) OVER (PARTITION BY {ks}, {_B} ORDER BY {order_s} ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND CURRENT ROW) AS `_wl_run_{n}`"
        for n in sums
    ]
    in_bucket += [
        f"last(`{c}`, true) OVER (PARTITION BY {ks}, {_B} ORDER BY {order_s} ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND CURRENT ROW) AS `_wl_if_{c}`"
        for c in ffill
    ]
    desc = ", ".join(f"`{c}` DESC" for c in order)
    in_bucket += [
        f"last(`{c}`, true) OVER (PARTITION BY {ks}, {_B} ORDER BY {desc} ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND CURRENT ROW) AS `_wl_ib_{c}`"
        for c in bfill
    ]
    scanned = base.selectExpr("*", *in_bucket)
    joined = scanned.join(per_bucket, [*keys, _B], "left")

    out = [f"`{c}`" for c in df.columns]
    out += [f"CASE WHEN _wl_is_first THEN _wl_plast.`{c}` ELSE `_wl_p_{c}` END AS `{prev_prefix}{c}`" for c in prev]
    out += [f"CASE WHEN _wl_is_last THEN _wl_nfirst.`{c}` ELSE `_wl_n_{c}` END AS `{next_prefix}{c}`" for c in next]
    out += [f"_wl_tfirst.`{c}` AS `track_first_{c}`" for c in track_first]
    out += [f"_wl_tlast.`{c}` AS `track_last_{c}`" for c in track_last]
    if track_count:
        out.append(f"CAST(_wl_tcount AS BIGINT) AS `{track_count}`")
    out += [f"coalesce(`_wl_if_{c}`, `_wl_pfl_{c}`) AS `ffill_{c}`" for c in ffill]
    out += [f"coalesce(`_wl_ib_{c}`, `_wl_nbf_{c}`) AS `bfill_{c}`" for c in bfill]
    for n in sums:
        total = f"(`_wl_run_{n}` + `_wl_off_{n}`)"
        out.append(f"CAST({total} - 1 AS BIGINT) AS `{n}`" if n == index else f"{total} AS `{n}`")
    return joined.selectExpr(*out)


def mark_scan(
    df: DataFrame,
    mark: str,
    *,
    prev: Sequence[str],
    first: bool,
    key: str | Sequence[str] = "mmsi",
    order: Sequence[str] = ("ts", "lat", "lon"),
    ts: str = "ts",
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Compare each row with the one before it in its track and count, in one
    pass: what takes ``track_scan`` a scan for the previous row and another one
    for the running sum.

    ``mark`` is a condition on the row's columns and ``prev_<column>`` of the
    columns ``prev``; null counts as false, and a track's first row has ``first``.
    Adds ``_mark`` (does it hold), ``_run`` (marks up to and with this row),
    ``_next`` (does it hold for the next row; null for the track's last),
    ``_head`` (is this the track's first row), ``_marks`` and ``_rows`` (of the
    whole track).

    The rows are shuffled once, on (key, bucket). A bucket is summed up by its
    first and last row, its number of rows and of marks between them; these
    summaries, one row per bucket, are put together in time order and joined
    back. They hold whole rows, so both uses of the shuffle need the same columns
    and Spark reads it twice instead of making it twice. Rows without a key or a
    time belong to no track and are dropped.
    """

    keys = [key] if isinstance(key, str) else list(key)
    ks = ", ".join(f"`{k}`" for k in keys)
    order_s = ", ".join(f"`{c}`" for c in order)
    row = "struct(" + ", ".join(f"`{c}`" for c in df.columns) + ")"
    base = df.selectExpr("*", f"CAST(floor(unix_seconds(CAST(`{ts}` AS TIMESTAMP)) / {int(bucket_seconds)}) AS BIGINT) AS {_B}").where(
        " AND ".join(f"{c} IS NOT NULL" for c in [*(f"`{k}`" for k in keys), _B]))
    w = f"(PARTITION BY {ks}, {_B} ORDER BY {order_s})"
    lagged = base.selectExpr("*", *[f"lag(`{c}`) OVER {w} AS `prev_{c}`" for c in prev], f"row_number() OVER {w} AS _wl_at")
    marked = lagged.selectExpr(*[f"`{c}`" for c in df.columns], _B, "_wl_at", f"_wl_at > 1 AND coalesce({mark}, false) AS _wl_in")
    rows = marked.selectExpr(
        "*", f"sum(CAST(_wl_in AS BIGINT)) OVER (PARTITION BY {ks}, {_B} ORDER BY {order_s} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _wl_run",
        f"lead(_wl_in) OVER {w} AS _wl_next")

    ends = marked.groupBy(*keys, _B).agg(
        F.expr(f"min_by({row}, struct({order_s})) AS _wl_first"), F.expr(f"max_by({row}, struct({order_s})) AS _wl_last"),
        F.expr("count(1) AS _wl_n"), F.expr("sum(CAST(_wl_in AS BIGINT)) AS _wl_tot"))
    by = f"PARTITION BY {ks} ORDER BY {_B}"
    before = f"OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    known = ends.selectExpr(*[f"`{k}` AS `_wl_k_{k}`" for k in keys], f"{_B} AS _wl_k_b", "_wl_n", "_wl_tot", f"lag(_wl_last) OVER ({by}) AS _wl_prev", "_wl_first")
    known = known.selectExpr(
        "_wl_first.*", *[f"`_wl_k_{k}`" for k in keys], "_wl_k_b", "_wl_n", "_wl_tot", "_wl_prev IS NULL AS _wl_head",
        *[f"_wl_prev.`{c}` AS `prev_{c}`" for c in prev])
    known = known.selectExpr(
        *[f"`_wl_k_{k}` AS `{k}`" for k in keys], f"_wl_k_b AS {_B}", "_wl_n", "_wl_tot", "_wl_head",
        f"IF(_wl_head, {str(first).lower()}, coalesce({mark}, false)) AS _wl_fm")
    known = known.selectExpr("*", "_wl_tot + CAST(_wl_fm AS BIGINT) AS _wl_all").selectExpr(
        *[f"`{k}`" for k in keys], _B, "_wl_head", "_wl_fm", f"coalesce(sum(_wl_all) {before}, 0) + CAST(_wl_fm AS BIGINT) AS _wl_off",
        f"lead(_wl_fm) OVER ({by}) AS _wl_nfm", f"sum(_wl_all) OVER (PARTITION BY {ks}) AS _wl_marks", f"sum(_wl_n) OVER (PARTITION BY {ks}) AS _wl_rows")
    return rows.join(known.repartition(*[F.col(k) for k in keys], F.col(_B)), [*keys, _B]).selectExpr(
        *[f"`{c}`" for c in df.columns], "IF(_wl_at = 1, _wl_fm, _wl_in) AS _mark", "_wl_off + _wl_run AS _run",
        "coalesce(_wl_next, _wl_nfm) AS _next", "_wl_at = 1 AND _wl_head AS _head", "_wl_marks AS _marks", "_wl_rows AS _rows")


def _sql(v) -> str:
    if isinstance(v, str):
        return v
    raise TypeError("cumsum expressions are given as Spark SQL text")


def with_prev(df: DataFrame, cols: Iterable[str], **kw) -> DataFrame:
    return track_scan(df, prev=cols, **kw)


def with_next(df: DataFrame, cols: Iterable[str], **kw) -> DataFrame:
    return track_scan(df, next=cols, **kw)


def with_index(df: DataFrame, name: str = "point_index", **kw) -> DataFrame:
    return track_scan(df, index=name, **kw)


def with_cumsum(df: DataFrame, sums: Mapping[str, str], **kw) -> DataFrame:
    return track_scan(df, cumsum=sums, **kw)
