"""Exact k-nearest-neighbour join in a feature space, and the distance-weighted
vote on top of it.

Rows are placed in cells: each belongs to its nearest pivot and, by its distance
to it, to one of that pivot's rings, which are as many as the pivot's rows
demand. A query first searches its own cell; the k-th distance found there (or,
where the cell has too few rows, one that the pivots' counts and radii
guarantee) bounds its true k-th distance. By the triangle inequality only the
rings between distance - bound and distance + bound of a pivot can hold a nearer
row, and none of a pivot that is more than twice the bound further away than the
query's own. Those cells are searched in a second pass, all of them.

Of rows equal in all features only the first k by id can be among the k nearest,
so copies go before anything else; equal queries are searched once. A cell with
many rows or many visiting queries is dealt into blocks, and each pair of blocks
is a group of its own. A group returns the best k of each query.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wakeline.scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

MAX_PIVOTS = 512  # sent to every task: a fixed bound, whatever the number of rows
CELL_ROWS = 512
BLOCK_ROWS, BLOCK_QUERIES = 2048, 4096
_SLACK = 1e-9


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return values.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, added up one dimension after the other."""

    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = a[:, j, None] - b[None, :, j]
        out += d * d
    return out


def _home(pivots: np.ndarray):
    """Rows with x to rows with the nearest pivot p and the distance r to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                d2 = _squares(_matrix(part.column("x")), pivots)
                p = d2.argmin(axis=1)
                r = np.sqrt(d2[np.arange(len(p)), p])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(p.astype(np.int32)), pa.array(r)], names=[*part.schema.names, "p", "r"])

    return run


def _visits(pivots: np.ndarray, rows: np.ndarray, radius: np.ndarray, width: np.ndarray, rings: np.ndarray, k: int, home: bool):
    """Queries (q, x, u) to the cells (p, ring) they search: their own, or all
    others within reach, ``u`` being the squared k-th distance known so far. An
    own ring beyond the pivot's last one is that last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                d = np.sqrt(_squares(_matrix(part.column("x")), pivots))
                every = np.arange(len(d))
                own = d.argmin(axis=1)
                least = d[every, own]
                ring = np.minimum(least // width[own], rings[own] - 1).astype(np.int64)
                if home:
                    yield pa.RecordBatch.from_arrays(
                        [part.column("q"), part.column("x"), pa.nulls(len(d), pa.float64()), pa.array(own.astype(np.int32)), pa.array(ring)],
                        names=["q", "x", "u", "p", "ring"])
                    continue
                far = d + radius[None, :]
                order = np.argsort(far, axis=1)
                enough = np.cumsum(rows[order], axis=1) >= k
                sure = np.where(enough.any(axis=1), far[every, order[every, enough.argmax(axis=1)]], np.inf)
                u2 = part.column("u").to_numpy(zero_copy_only=False)
                u = np.minimum(sure, np.sqrt(np.where(np.isnan(u2), np.inf, u2))) * (1 + _SLACK) + _SLACK
                reach = np.maximum((d - least[:, None]) / 2, d - radius[None, :]) <= u[:, None]
                who, p = np.nonzero(reach)
                with np.errstate(invalid="ignore"):
                    first = np.maximum(np.floor((d[who, p] - u[who]) / width[p] - _SLACK), 0)
                    last = np.minimum(np.floor((d[who, p] + u[who]) / width[p] + _SLACK), rings[p] - 1)
                first, last = first.astype(np.int64), last.astype(np.int64)
                n = np.maximum(last - first + 1, 0)
                who, p = np.repeat(who, n), np.repeat(p, n)
                at_ring = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
                new = (p != own[who]) | (at_ring != ring[who])
                take = pa.array(who[new])
                yield pa.RecordBatch.from_arrays(
                    [part.column("q").take(take), part.column("x").take(take), pa.array(u2[who[new]], from_pandas=True),
                     pa.array(p[new].astype(np.int32)), pa.array(at_ring[new])], names=["q", "x", "u", "p", "ring"])

    return run


def _best(k: int):
    """Queries (q, x, u) against rows (t, label, x) of one pair of blocks: the
    best k rows of each query by distance, then id, none further than u."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("t", "ascending")]))
        found = []
        if len(queries) and len(rows):
            a, b = _matrix(queries.column("x")), _matrix(rows.column("x"))
            u = queries.column("u").to_numpy()
            u = np.where(np.isnan(u), np.inf, u)
            for at in range(0, len(a), 256):
                d2 = _squares(a[at: at + 256], b)
                near = d2 <= u[at: at + 256, None]
                if len(b) > k:
                    near &= d2 <= np.partition(d2, k - 1, axis=1)[:, k - 1, None]
                q, t = np.nonzero(near)
                d = d2[q, t]
                by = np.lexsort((t, d, q))
                q, t, d = q[by], t[by], d[by]
                top = np.arange(len(q)) - np.searchsorted(q, q) < k
                found.append((q[top] + at, t[top], d[top]))
        q, t, d = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64),) * 3
        return pa.table({
            "q": queries.column("q").take(pa.array(q.astype(np.int64))), "t": rows.column("t").take(pa.array(t.astype(np.int64))),
            "label": rows.column("label").take(pa.array(t.astype(np.int64))), "d2": pa.array(d.astype(np.float64))})

    return run


def nearest_rows(
    rows: DataFrame, queries: DataFrame, k: int, row_id: str = "rid", query_id: str = "rid", vector: str = "x", label: str = "label",
) -> DataFrame:
    """The ``k`` nearest of ``rows`` to each of ``queries``: (query, rank,
    neighbour, label, distance), by Euclidean distance, then ``row_id``; all rows
    where there are fewer than k. Vectors are array<double> of one length; rows
    and queries whose vector is null take no part. Sums of squares are formed in
    the order of the dimensions, so equal distances tie exactly."""

    spark = rows.sparkSession
    scratch = Scratch(spark, "knn")
    order = F.row_number().over(W.partitionBy("x").orderBy("t"))
    sites = scratch.write(rows.where(f"`{vector}` IS NOT NULL").select(
        F.col(row_id).alias("t"), F.col(label).alias("label"), F.col(vector).alias("x")).withColumn("copy", order).where(F.col("copy") <= k), "sites")
    asked = queries.where(f"`{vector}` IS NOT NULL").select(F.col(query_id).alias("query"), F.col(vector).alias("x"))
    n = sites.count()
    pivots = min(MAX_PIVOTS, max(1, math.isqrt(n) // 4))
    chosen = sites.where("copy = 1").orderBy(F.xxhash64("x"), "x").limit(pivots).select("x").toArrow()
    kind, name = sites.schema["t"].dataType.simpleString(), sites.schema["label"].dataType.simpleString()
    if not n:
        return asked.where("false").selectExpr("query", "1 AS rank", f"CAST(NULL AS {kind}) AS neighbour", f"CAST(NULL AS {name}) AS label", "0D AS distance")
    at = _matrix(chosen.column("x"))
    placed = scratch.write(sites.select("t", "label", "x").mapInArrow(_home(at), f"t {kind}, label {name}, x array<double>, p int, r double"), "placed")

    # one row per pivot: at most MAX_PIVOTS
    held = np.zeros(len(at), dtype=np.int64)
    radius = np.full(len(at), -np.inf)
    for row in placed.groupBy("p").agg(F.count("*").alias("n"), F.max("r").alias("r")).collect():
        held[row["p"]], radius[row["p"]] = row["n"], row["r"]
    rings = np.maximum(-(-held // CELL_ROWS), 1)
    width = np.maximum(np.where(held > 0, radius, 0.0) / rings, 1e-300)
    table = spark.createDataFrame([(p, float(w), int(c)) for p, (w, c) in enumerate(zip(width, rings, strict=True))], "p int, width double, rings long")
    placed = placed.join(F.broadcast(table), "p").withColumn("ring", F.expr("least(CAST(floor(r / width) AS BIGINT), rings - 1)")).drop("r", "width", "rings")
    cells = scratch.write(placed.groupBy("p", "ring").count(), "cells")

    plain = scratch.write(asked.groupBy("x").agg(F.count("*").alias("n")).select("x", F.monotonically_increasing_id().alias("q")), "queries")

    def search(visits: DataFrame, step: str) -> DataFrame:
        visits = scratch.write(visits, f"{step}-visits")
        dealt = visits.groupBy("p", "ring").agg(F.count("*").alias("v")).join(cells, ["p", "ring"]).select(
            "p", "ring", F.ceil(F.col("count") / BLOCK_ROWS).alias("ni"), F.ceil(F.col("v") / BLOCK_QUERIES).alias("nj"))
        left = visits.join(dealt, ["p", "ring"]).withColumns(
            {"j": F.expr("pmod(xxhash64(q), nj)"), "i": F.explode(F.expr("sequence(0L, ni - 1)"))}).select("p", "ring", "i", "j", "q", "x", "u")
        right = placed.join(dealt, ["p", "ring"]).withColumns(
            {"i": F.expr("pmod(xxhash64(t), ni)"), "j": F.explode(F.expr("sequence(0L, nj - 1)"))}).select("p", "ring", "i", "j", "t", "label", "x")
        keys = ["p", "ring", "i", "j"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best(k), f"q long, t {kind}, label {name}, d2 double")
        return _top(found)

    def _top(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("q").orderBy("d2", "t"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    cell = "q long, x array<double>, u double, p int, ring long"
    shape = (at, held, np.where(held > 0, radius, -np.inf), width, rings, k)
    first = scratch.write(search(plain.select("q", "x").mapInArrow(_visits(*shape, True), cell), "own"), "own")
    known = first.where(f"rank = {int(k)}").select("q", F.col("d2").alias("u"))
    more = search(plain.join(known, "q", "left").select("q", "x", "u").mapInArrow(_visits(*shape, False), cell), "others")
    both = scratch.write(_top(first.drop("rank").unionByName(more.drop("rank"))), "nearest")
    return asked.join(plain.select("x", "q"), "x").join(both, "q").select(
        "query", "rank", F.col("t").alias("neighbour"), "label", F.sqrt("d2").alias("distance"))


def weighted_vote(neighbours: DataFrame) -> DataFrame:
    """(query, prediction, probability) of ``nearest_rows``' result: neighbours
    weigh 1 / distance, unless some lie at distance zero, which then weigh alone
    and alike. Equal sums (to 1e-9 of all weight) go to the smaller label."""

    near = neighbours.groupBy("query").agg(F.expr("sort_array(collect_list(struct(rank, label, distance))) AS n"))  # at most k
    near = near.withColumn("hit", F.expr("exists(n, s -> s.distance = 0D)"))
    weight = "IF(hit, IF(s.distance = 0D, 1D, 0D), 1D / s.distance)"
    total = "aggregate({}, 0D, (a, s) -> a + " + weight + ")"
    share = total.format("filter(n, s -> s.label = l)") + " / " + total.format("n")
    best = f"array_min(transform(array_distinct(transform(n, s -> s.label)), l -> named_struct('p', -round({share}, 9), 'l', l)))"
    return near.selectExpr("query", f"{best} AS b").selectExpr("query", "b.l AS prediction", "-b.p AS probability")
