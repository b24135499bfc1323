"""Embedding near-dedup with spherical k-means cells.

Vectors equal in every component are merged first (with their number). Unit
centroids are fitted by spherical k-means on a bounded sample (``SAMPLE``
vectors with the smallest hash); the number of cells grows with the number of
vectors. Every vector has its home in the cell of the largest cosine and also
visits each cell whose boundary with the home cell is near: a vector within the
linking angle on the other side of the boundary can exist only if the vector's
own distance to the boundary is at most sin(angle), and ``MARGIN`` is the part
of that distance that is searched. With margin 1 the search is exact whatever
the data; the cells of high-dimensional vectors then overlap nearly wholly,
so the default searches 0.4 of it, four times the spread that a link of random
direction has in 100 dimensions. tests/llm measures the recall against brute
force.

Within a cell the home vectors are compared with all its vectors, in blocks of
at most about ``BLOCK`` by ``BLOCK``, each a product in double precision; home
vectors and all vectors of a cell with more are dealt into blocks by a hash, and
every pair of a home block and a block of all is a group of its own. Long vectors
are first compared by a product of ``PART`` of their dimensions, turned at random,
plus the product of the lengths of the rest, which is never below the cosine; the
pairs that it leaves are settled in double precision.

A vector visits more cells the more there are, so its copies are not made at once:
vectors and the numbers of their cells are written once, and the groups are dealt
into waves whose copies take about as much as the vectors. What a wave shuffled is
deleted before the next. Every link is counted at the home of either end; a visitor
whose own home is not visited by the other end is counted where it visits, so a
link found at all counts at both ends, once each. A group returns a link count for each home vector and a spanning forest of its links,
not the links. Components come from contraction; the representative of a group
is its smallest id.

Vectors that are null, zero, or hold null or non-finite components link with
nothing, and vectors of different length never link with each other. A null id
is an ordinary row, but never names a component unless all its ids are null.
Rows that repeat an id or a vector count each. Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.batches import mix64, spanning
from wakeline.operators.components import connected_components
from wakeline.scratch import Scratch, shuffles_removed

COSINE = 0.95
MARGIN = 0.4
CELL_ROWS = 512
MAX_CELLS = 4096
SAMPLE = 16_384
ROUNDS = 8
BLOCK = 8192
PART = 0.25
DENSE = 0.02  # share of pairs left by the first product from which all are settled by one product
WAVE_BYTES = 128 << 20  # a wave's copies, if the vectors are smaller


def kmeans(x: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of spherical k-means over unit rows, begun at rows spread
    evenly over ``x``; a centroid without rows stays where it is."""

    c = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(rounds):
        home = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit rows, in double precision, of a list column of one length."""

    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _fit(spark: SparkSession, vectors: DataFrame, cells: int) -> dict[int, np.ndarray]:
    """Centroids for each vector length in the sample."""

    table = vectors.orderBy("k1", "k2").limit(SAMPLE).select("dim", "e").toArrow()
    out = {}
    for dim in sorted(set(table.column("dim").to_pylist())):
        part = table.filter(pa.compute.equal(table.column("dim"), dim)).column("e").combine_chunks()
        out[dim] = kmeans(_matrix(part), cells)
    return out


def _assign(centroids: dict[int, np.ndarray], cosine: float, margin: float):
    """Rows with dim and e, to the same with the home cell ``base`` and all cells visited."""

    reach = margin * float(np.sqrt(1 - cosine * cosine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                c = centroids.get(dim)
                for at in range(0, rows.num_rows, 1024):
                    part = rows.slice(at, 1024)
                    if c is None:
                        home = cell = np.zeros(part.num_rows, dtype=np.int64)
                        width = np.ones(part.num_rows, dtype=np.int64)
                    else:
                        s = _matrix(part.column("e")) @ c.T
                        home = s.argmax(axis=1)
                        best = s[np.arange(len(s)), home]
                        apart = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0.0))[home]
                        near = best[:, None] - s <= reach * apart + 1e-12
                        near[np.arange(len(s)), home] = True
                        cell = np.nonzero(near)[1]
                        width = near.sum(axis=1)
                    visits = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(width)].astype(np.int32)), pa.array(cell.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(home.astype(np.int32)), visits], names=[*part.schema.names, "base", "visits"])

    return run


def _plan(cells: list[tuple[int, int, int, int]], block: int, size: int, wave_bytes: int) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """From (dim, cell, home vectors, all vectors) in order, elements of ``size``
    bytes: for each dim, by cell, the blocks of home and of all vectors, the bytes
    of copies before the cell and of each home block; and the number of waves."""

    plans = {dim: tuple(np.zeros(last + 1, dtype=np.int64) for _ in range(4)) for dim, last in {d: c for d, c, _, _ in cells}.items()}
    before = 0
    for dim, cell, home, every in cells:
        m, k = -(-home // block), -(-every // block)
        each = (-(-home // max(1, m)) * k + every) * (size * dim + 64)
        for column, value in zip(plans[dim], (m, k, before, each), strict=True):
            column[cell] = value
        before += m * each
    return plans, before // wave_bytes + 1


def _copies(plans: dict[int, tuple[np.ndarray, ...]], wave: int, wave_bytes: int):
    """Rows (v, n, dim, base, visits, e) to the rows of the groups (dim, cell, i, j)
    of one wave: home vectors as queries in each block j of their cell, every
    vector as another in each home block i of the cells that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                homes, others, before, each = plans[dim]
                for at in range(0, rows.num_rows, 1024):
                    part = rows.slice(at, 1024)
                    mixed = mix64(part.column("v").to_numpy())
                    base = part.column("base").to_numpy()
                    visits = part.column("visits")
                    row, cell = pa.compute.list_parent_indices(visits).to_numpy(), visits.flatten().to_numpy()
                    first, last = before[cell] // wave_bytes, (before[cell] + (homes[cell] - 1) * each[cell]) // wave_bytes
                    on = (first <= wave) & (wave <= last)
                    row, cell = row[on], cell[on]
                    own = (mixed[row] % np.maximum(homes[cell], 1).astype(np.uint64)).astype(np.int64)
                    mine = (mixed[row] % others[cell].astype(np.uint64)).astype(np.int64)
                    home = base[row] == cell

                    def every(k: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                        which = np.flatnonzero(pick)
                        times = k[cell[which]]  # noqa: B023
                        return np.repeat(which, times), np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)

                    a, j = every(others, home)  # as queries, with their own block also as others
                    b, i = every(homes, np.ones(len(row), dtype=bool))
                    keep = ~(home[b] & (i == own[b]))
                    b, i = b[keep], i[keep]
                    which, i, j = np.r_[a, b], np.r_[own[a], i], np.r_[j, mine[b]]
                    query = np.arange(len(which)) < len(a)
                    other = ~query | (j == mine[which])
                    keep = (before[cell[which]] + i * each[cell[which]]) // wave_bytes == wave
                    which, i, j, query, other = which[keep], i[keep], j[keep], query[keep], other[keep]
                    for s in range(0, len(which), 16384):
                        w = which[s: s + 16384]
                        q = query[s: s + 16384]
                        taken = part.take(pa.array(row[w]))
                        yield pa.RecordBatch.from_arrays(
                            [taken.column("dim"), pa.array(cell[w]), pa.array(i[s: s + 16384].astype(np.int32)), pa.array(j[s: s + 16384].astype(np.int32)),
                             taken.column("v"), taken.column("n"), pa.array(q), pa.array(other[s: s + 16384]), taken.column("base"),
                             visits.take(pa.array(row[w], mask=~q)), taken.column("e")],
                            names=["dim", "cell", "i", "j", "v", "n", "query", "other", "base", "visits", "e"])

    return run


def _turned(x: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows turned by a fixed rotation: ``part`` of the dimensions, and the length of the rest."""

    some = x @ np.linalg.qr(np.random.default_rng(0).normal(size=(x.shape[1], part)))[0]
    rest = np.sqrt(np.maximum(1 - (some * some).sum(axis=1), 0.0))
    return some.astype(np.float32), rest.astype(np.float32)


def _compare(cosine: float):
    """Groups (dim, cell, i, j) of rows (v, n, query, other, base, visits, e),
    sorted; emits (a, links, null) for each query or visitor and (a, null, b) for a spanning forest."""

    def links(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        v, n = t.column("v").to_numpy(), t.column("n").to_numpy()
        query, other = (t.column(c).to_numpy() for c in ("query", "other"))
        if not query.any() or len(v) < 2:
            return
        x = _matrix(t.column("e").combine_chunks())
        qi, oi = np.flatnonzero(query), np.flatnonzero(other)
        dims = int(PART * x.shape[1])
        if dims >= 8:
            some, rest = _turned(x, dims)
            some = np.c_[some, rest]
        sparse = dims >= 8
        count = np.zeros(len(qi), dtype=np.int64)
        base, visits = t.column("base").to_numpy(), t.column("visits").combine_chunks()
        guests = np.flatnonzero(base[oi] != t.column("cell")[0].as_py())
        extra = np.zeros(len(oi), dtype=np.int64)
        cells = int(base.max()) + 1
        a, b = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for at in range(0, len(qi), 512):
            q = qi[at: at + 512]
            if sparse:
                near = some[q] @ some[oi].T >= np.float32(cosine - 1e-4)
                sparse = near.mean() < DENSE  # else the rest is settled by whole products
            if sparse:
                r, c = np.nonzero(near)
                hit = (np.einsum("ij,ij->i", x[q[r]], x[oi[c]]) >= cosine) & (v[q[r]] != v[oi[c]])
                r, c = r[hit], c[hit]
            else:
                r, c = np.nonzero((x[q] @ x[oi].T >= cosine) & (v[q][:, None] != v[oi][None, :]))
            count[at: at + 512] = np.bincount(r, weights=n[oi[c]], minlength=len(q))
            if len(guests):  # those that do not find the link at their own home
                seen = np.zeros((len(q), cells), dtype=bool)
                lists = visits.take(pa.array(q))
                row, cell = pa.compute.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy()
                seen[row[cell < cells], cell[cell < cells]] = True
                guest = ~seen[r, base[oi[c]]]  # a home row's own cell is always visited
                extra += np.bincount(c[guest], weights=n[q[r[guest]]], minlength=len(oi)).astype(np.int64)
            a, b = spanning(np.concatenate([a, v[q][r]]), np.concatenate([b, v[oi][c]]))
        ends = np.r_[v[qi][count > 0], v[oi][extra > 0]]
        counts = np.r_[count[count > 0], extra[extra > 0]]
        k = len(ends) + len(a)
        if k:
            none = np.zeros(k, dtype=bool)
            none[: len(ends)] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[ends, a]), pa.array(np.r_[counts, np.zeros(len(a), dtype=np.int64)]),
                 pa.array(np.r_[np.zeros(len(ends), dtype=np.int64), b], mask=none)], names=["a", "links", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last: tuple | None = None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("dim", "cell", "i", "j")])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                this = tuple(key[:, lo].tolist())
                if held and this != last:
                    yield from links(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = this
        if held:
            yield from links(held)

    return run


def near_duplicates(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, margin: float = MARGIN,
    cell_rows: int = CELL_ROWS, block: int = BLOCK,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of ``table``."""

    spark = table.sparkSession
    scratch = Scratch(spark, "embeddings")
    kind = table.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and kind.elementType == T.FloatType()
    vector = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    double = F.col("e").cast("array<double>")
    sound = F.expr("e IS NOT NULL AND size(e) > 0 AND forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(e, x -> x <> 0)")
    read = table.select(F.col(id_col).alias("id"), vector.alias("e")).withColumn("sound", F.coalesce(sound, F.lit(False))).withColumns(
        {"k1": F.when(F.col("sound"), F.xxhash64(double)), "k2": F.when(F.col("sound"), F.hash(double))})
    with shuffles_removed(spark):
        rows = scratch.write(read.select("id", "k1", "k2"), "rows")
        merged = read.filter("sound").groupBy("k1", "k2").agg(
            F.count("*").alias("n"), F.min("id").alias("low"), F.first("e").alias("e")).withColumn("dim", F.size("e")).withColumn("v", F.monotonically_increasing_id())
        vectors = scratch.write(merged, "vectors")
        cells = max(1, min(MAX_CELLS, -(-vectors.count() // cell_rows)))
        centroids = _fit(spark, vectors, cells)
        placed = scratch.write(vectors.mapInArrow(_assign(centroids, cosine, margin), T.StructType(
            [*vectors.schema.fields, T.StructField("base", T.IntegerType()), T.StructField("visits", T.ArrayType(T.IntegerType()))])), "cells")
        scratch.drop(vectors)
        vectors = placed.select("v", "k1", "k2", "n", "low", "dim")
        sizes = placed.select("dim", F.explode("visits").alias("cell"), "base").groupBy("dim", "cell").agg(
            F.sum((F.col("cell") == F.col("base")).cast("long")).alias("home"), F.count("*").alias("all")).orderBy("dim", "cell").collect()  # a row per cell
        size = 4 if single else 8
        wave_bytes = max(WAVE_BYTES, placed.agg(F.sum(F.col("dim").cast("long") * size + 64)).first()[0] or 0)
        plans, waves = _plan([tuple(r) for r in sizes], block, size, wave_bytes)
        found = None
        for wave in range(waves):
            groups = placed.select("v", "n", "dim", "base", "visits", "e").mapInArrow(
                _copies(plans, wave, wave_bytes), "dim int, cell int, i int, j int, v long, n long, query boolean, other boolean, base int,"
                f" visits array<int>, e array<{'float' if single else 'double'}>").repartition("dim", "cell", "i", "j").sortWithinPartitions("dim", "cell", "i", "j")
            made = scratch.write(groups.mapInArrow(_compare(cosine), "a long, links long, b long"), "links")
            found = made if found is None else found.unionByName(made)
        counts = found.filter("b IS NULL").groupBy(F.col("a").alias("v")).agg(F.sum("links").alias("links"))
        comp = connected_components(spark, found.filter("b IS NOT NULL").select("a", "b"), "embeddings-cc")
        rooted = vectors.select("v", "k1", "k2", "n", "low").join(comp.withColumnRenamed("node", "v"), "v", "left").withColumn("root", F.coalesce("root", "v"))
        lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
        known = scratch.write(rooted.join(lowest, "root").join(counts, "v", "left").select(
            "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "known")
    return rows.join(known, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("k1").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
