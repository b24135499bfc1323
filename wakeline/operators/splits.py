"""Leakage-safe splits as deterministic, hash-ordered DataFrame plans.

Every "random" choice is a fixed integer hash of the group id, so a split is
reproducible across runs, engines and partitionings. Exact k-smallest picks
use a histogram of hash buckets (a tiny aggregate) to find the cut, then rank
only the rows of the one bucket that straddles it — never a global window
over all rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A 31-bit linear congruential hash of the id.
HASH_MOD = 2147483648
HASH_MUL = 1103515245
HASH_ADD = 12345
HIST_BUCKETS = 4096


def id_hash_sql(col: str) -> str:
    return f"pmod(pmod(CAST({col} AS BIGINT), {HASH_MOD}) * {HASH_MUL} + {HASH_ADD}, {HASH_MOD})"


def smallest_k(items: DataFrame, k: int, order: str, tiebreak: str) -> DataFrame:
    """The ``k`` rows with the smallest (order, tiebreak), exactly.

    ``order`` must be a non-negative integer below ``HASH_MOD``.
    """

    if k <= 0:
        return items.limit(0)
    width = HASH_MOD // HIST_BUCKETS
    b = items.selectExpr("*", f"CAST({order} div {width} AS INT) AS _hb")
    hist = b.groupBy("_hb").agg(F.expr("count(1) AS _n")).selectExpr(
        "_hb", "_n", "sum(_n) OVER (ORDER BY _hb ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _before"
    ).selectExpr("_hb", "coalesce(_before, 0) AS _before", "_n")
    cut = hist.where(f"_before < {k} AND _before + _n > {k}").selectExpr("_hb AS _cut", "_before AS _cb")
    # the histogram has at most HIST_BUCKETS rows: a proven-size broadcast
    full = b.join(F.broadcast(hist.where(f"_before + _n <= {k}").select("_hb")), "_hb", "left_semi")
    edge = b.join(F.broadcast(cut), F.col("_hb") == F.col("_cut")).selectExpr(
        "*", f"row_number() OVER (ORDER BY {order}, {tiebreak}) AS _r"
    ).where(f"_cb + _r <= {k}").drop("_cut", "_cb", "_r")
    return full.unionByName(edge).drop("_hb")


def group_split(rows: DataFrame, group: str = "mmsi", test_size: float = 0.2) -> DataFrame:
    """Whole groups to one side: ``ceil(t * groups)`` groups (t clamped to
    0.05..0.5) with the smallest id hash form the test side. Adds ``is_test``."""

    t = min(max(float(test_size), 0.05), 0.5)
    groups = rows.select(group).distinct().selectExpr(group, f"{id_hash_sql(group)} AS _h")
    n = groups.count()
    k = int(math.ceil(t * n))
    test = smallest_k(groups, k, "_h", group).select(group).withColumn("is_test", F.lit(True))
    return rows.join(test, group, "left").selectExpr(
        *rows.columns, "coalesce(is_test, false) AS is_test"
    )


def group_folds(rows: DataFrame, group: str, label: str, k: int = 3) -> DataFrame:
    """Stratified group folds: each group's stratum is its majority class
    (smallest on a tie); within a stratum groups are dealt to folds in order
    of (rows desc, hash). Adds ``fold`` (0..k-1); a group is in one fold."""

    sizes = rows.groupBy(group, label).agg(F.expr("count(1) AS _c"))
    strata = sizes.groupBy(group).agg(
        F.expr(f"min_by({label}, struct(-_c, {label})) AS _stratum"), F.expr("sum(_c) AS _rows")
    )
    dealt = strata.selectExpr(
        group,
        f"CAST(pmod(row_number() OVER (PARTITION BY _stratum ORDER BY _rows DESC, {id_hash_sql(group)}, {group}) - 1,"
        f" {int(k)}) AS INT) AS fold",
    )
    return rows.join(dealt, group)


def stratified_row_split(rows: DataFrame, label: str, row_id: str, test_size: float = 0.2) -> DataFrame:
    """Leaky row-level split (the legacy baseline): of every class, the
    ``floor(t * n + 0.5)`` rows with the smallest id hash are test rows. Ranks come
    from counts by (class, hash bucket) and places inside a bucket, so no task
    holds a class. Adds ``is_test``."""

    t = min(max(float(test_size), 0.0), 1.0)
    width = HASH_MOD // HIST_BUCKETS
    marked = rows.withColumn("_h", F.expr(id_hash_sql(row_id))).withColumn("_b", F.expr(f"_h div {width}"))
    hist = marked.groupBy(F.col(label).alias("_l"), F.col("_b").alias("_hb")).agg(F.expr("count(1) AS _n")).selectExpr(
        "_l", "_hb", f"floor(sum(_n) OVER (PARTITION BY _l) * {t!r}D + 0.5D) AS _k",
        "coalesce(sum(_n) OVER (PARTITION BY _l ORDER BY _hb ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before")
    placed = marked.selectExpr("*", f"row_number() OVER (PARTITION BY {label}, _b ORDER BY _h, {row_id}) AS _r")
    return placed.join(hist, F.expr(f"{label} <=> _l AND _b = _hb")).selectExpr(*rows.columns, "_before + _r <= _k AS is_test")


def sample_search_groups(rows: DataFrame, group: str, label: str, max_groups: int) -> DataFrame:
    """The rows of at most about ``max_groups`` groups, taken by hash from every
    majority class in proportion (0: all rows)."""

    sizes = rows.groupBy(group, label).agg(F.expr("count(1) AS _c"))
    strata = sizes.groupBy(group).agg(F.expr(f"min_by({label}, struct(-_c, {label})) AS _stratum"))
    n = strata.count()
    if max_groups <= 0 or n <= max_groups:
        return rows
    kept = stratified_row_split(strata, "_stratum", group, max_groups / n).where("is_test").select(group)
    return rows.join(kept, group, "left_semi")


def temporal_split_points(rows: DataFrame, frac: float = 0.8, ts: str = "ts", row_id: str = "rid") -> DataFrame:
    """First ``frac`` of rows by time (ties by row id) train, the rest test.

    The cut is found from per-hour counts (a small histogram) and only the
    straddling hour is ranked. Adds ``is_test``.
    """

    f = min(max(float(frac), 0.5), 0.9)
    n = rows.count()
    k = int(math.floor(f * n))
    hrs = rows.selectExpr("*", f"CAST(unix_seconds({ts}) div 3600 AS BIGINT) AS _hr")
    hist = hrs.groupBy("_hr").agg(F.expr("count(1) AS _n")).selectExpr(
        "_hr", "_n", "coalesce(sum(_n) OVER (ORDER BY _hr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before"
    )
    marked = hrs.join(F.broadcast(hist), "_hr")
    edge = marked.where(f"_before < {k} AND _before + _n > {k}").selectExpr(
        "*", f"row_number() OVER (ORDER BY {ts}, {row_id}) AS _r"
    ).selectExpr(*rows.columns, f"_before + _r > {k} AS is_test")
    rest = marked.where(f"NOT (_before < {k} AND _before + _n > {k})").selectExpr(
        *rows.columns, f"_before >= {k} AS is_test"
    )
    return rest.unionByName(edge)


def cap_rows_by_group(rows: DataFrame, group: str = "mmsi", max_rows: int = 180000) -> DataFrame:
    """Whole groups in hash order until the running row count reaches
    ``max_rows`` (0 = no cap). The running sum runs over the group table
    (one row per group), not over rows."""

    if max_rows <= 0:
        return rows
    sizes = rows.groupBy(group).agg(F.expr("count(1) AS _n")).selectExpr(group, "_n", f"{id_hash_sql(group)} AS _h")
    run = sizes.selectExpr(
        group, f"coalesce(sum(_n) OVER (ORDER BY _h, {group} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before"
    )
    keep = run.where(f"_before < {int(max_rows)}").select(group)
    return rows.join(keep, group, "left_semi")


def leakage_overlap(split: DataFrame, group: str = "mmsi") -> DataFrame:
    """Groups on both sides and their share of the test groups."""

    g = split.groupBy(group).agg(F.expr("max(CAST(is_test AS INT)) AS t"), F.expr("min(CAST(is_test AS INT)) AS f"))
    return g.agg(
        F.expr("CAST(sum(CASE WHEN t = 1 AND f = 0 THEN 1 ELSE 0 END) AS BIGINT) AS overlap_groups"),
        F.expr("CAST(sum(t) AS BIGINT) AS test_groups"),
    ).selectExpr("*", "CASE WHEN test_groups = 0 THEN 0.0D ELSE overlap_groups / test_groups END AS overlap_ratio")


def split_profile(split: DataFrame, group: str = "mmsi", ts: str = "ts") -> DataFrame:
    """Rows, groups and time range of each side."""

    return split.groupBy("is_test").agg(
        F.expr("count(1) AS rows"), F.expr(f"count(DISTINCT {group}) AS groups"),
        F.expr(f"min({ts}) AS first_ts"), F.expr(f"max({ts}) AS last_ts"),
    )
