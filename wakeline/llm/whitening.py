"""Embedding whitening by an incremental eigendecomposition.

Vectors become integers first (``floor(SCALE * c) + OFFSET``), so counts, sums
and deviations are exact. Each partition keeps the spectrum of what it has read
and applies centred rank-one updates to it (``spectra.py``: secular equation,
deflation); blocks of rows are first turned into no more rows than dimensions.
The partitions' spectra meet in rounds of at most ``FAN`` per task, each joined
to the next by one update per component. The basis they end with is refined by a
distributed Rayleigh-Ritz step: every partition projects its centred vectors
on it and sums the products, and the small eigenproblem in that basis turns it
into the components. A last pass of the same kind measures the covariance of
the whitened vectors. Only matrices of dimension by dimension reach a task of
the rounds or the driver, whatever the number of rows; partial sums are joined
in the order of their partitions, so reruns agree.

Vectors that are null, empty or hold null or non-finite entries take no part
and have no row in the result. All vectors should have one length; those of
another than the commonest (of equally common ones, the longest) take no part
either. Scaled entries beyond 2^40 count as 2^40. A component whose eigenvalue
is zero to working precision (a constant dimension, fewer vectors than
dimensions) cannot be whitened and has no rows; so equal vectors alone, and a
single vector, have none. ``deviation`` is null where it exceeds a long. Ids may
repeat or be null; repeated rows count each. Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.spectra import EPS, Spectrum
from wakeline.scratch import Scratch

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
BLOCK = 4096
FAN = 16
STATE = "part long, state binary"
_LIMIT = float(1 << 40)


def _whole(batch: pa.RecordBatch) -> np.ndarray:
    """Rows of column ``v`` as whole numbers."""

    c = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return np.clip(np.floor(c * SCALE), -_LIMIT, _LIMIT).astype(np.int64) + OFFSET


def _state(data: bytes | np.ndarray) -> pa.RecordBatch:
    part = TaskContext.get().partitionId()
    return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "state": pa.array([bytes(data)], pa.binary())})


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, sums) of every batch of vectors."""

    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64()), "sums": pa.array([_whole(batch).sum(axis=0).tolist()], pa.list_(pa.int64()))})


class _Centre:
    """The exact mean, as a whole number and the rest, so that centring a large
    number loses nothing."""

    def __init__(self, n: int, sums: list[int]):
        self.base = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest


def _spectra(centre: _Centre, dim: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Spectrum(dim)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                seen.add(centre(_whole(batch.slice(at, block))))
        if seen.n:
            yield _state(seen.to_bytes())

    return run


def _join_spectra(states: list[bytes]) -> bytes:
    first, *rest = (Spectrum.from_bytes(s) for s in states)
    for other in rest:
        first.join(other)
    return first.to_bytes()


def _products(centre: _Centre, basis: np.ndarray):
    """Sum of y'y over the centred rows y, projected on ``basis``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                y = centre(_whole(batch.slice(at, BLOCK))) @ basis
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield _state(total.tobytes())

    return run


def _add(states: list[bytes]) -> bytes:
    return sum(np.frombuffer(s) for s in states).tobytes()


def _rounds(scratch: Scratch, states: DataFrame, join: Callable[[list[bytes]], bytes], name: str) -> bytes:
    """Join all states in the order of their parts, at most ``FAN`` in a task."""

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "state": pa.array([join(table.column("state").to_pylist())], pa.binary())})

    held = scratch.write(states, name)
    while True:
        last = held.agg(F.max("part")).first()[0]
        if last == 0 or held.count() == 1:
            return bytes(held.first()["state"])
        held = scratch.write(held.groupBy(F.expr(f"part DIV {FAN}").alias("g")).applyInArrow(meet, STATE), name)


def _whiten(centre: _Centre, matrix: np.ndarray, n: int, sums: list[int]):
    """Rows (id, v) to (id, deviation, w)."""

    total = np.array(sums, dtype=object)

    def deviations(x: np.ndarray) -> pa.Array:
        most = (np.abs(centre(x)).max() + 1.0) * n
        if most * most * x.shape[1] < 2.0**62 and n * (float(np.abs(x).max()) + 1.0) < 2.0**62:
            y = n * x - total.astype(np.int64)
            return pa.array((y * y).sum(axis=1))
        y = n * x.astype(object) - total
        return pa.array([int(d) if d < 1 << 63 else None for d in (y * y).sum(axis=1)], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _whole(part)
                w = centre(x) @ matrix
                ends = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), deviations(x), pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))], names=["id", "deviation", "w"])

    return run


def whiten(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, block: int = BLOCK,
) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error):
    a row for each sound vector and each of the first ``components`` components."""

    spark = table.sparkSession
    scratch = Scratch(spark, "whitening")
    sound = table.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")).filter(
        "v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    kind = table.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    out = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    common = sound.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)
    dim, n = common
    rows = sound.filter(F.size("v") == dim)
    sums = [int(r[0]) for r in rows.select("v").mapInArrow(_sums, "n long, sums array<long>").select(F.posexplode("sums").alias("at", "s")).groupBy(
        "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").select("s").collect()]
    centre = _Centre(n, sums)

    found = Spectrum.from_bytes(_rounds(scratch, rows.select("v").mapInArrow(_spectra(centre, dim, block), STATE), _join_spectra, "spectra"))
    basis = found.vectors[:, ::-1]
    ritz = np.frombuffer(_rounds(scratch, rows.select("v").mapInArrow(_products(centre, basis), STATE), _add, "ritz")).reshape(dim, dim) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    trace = float(values.sum())
    keep = min(components, int((values > dim * 8 * EPS * max(values[0], 0.0)).sum()))
    if not keep:
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)
    matrix = vectors[:, :keep] / np.sqrt(values[:keep])
    check = np.frombuffer(_rounds(scratch, rows.select("v").mapInArrow(_products(centre, matrix), STATE), _add, "check")).reshape(keep, keep) / n
    error = float(np.abs(check - np.eye(keep)).max())

    explained = F.array(*[F.lit(float(v / trace)) for v in values[:keep]])
    white = rows.mapInArrow(_whiten(centre, matrix, n, sums), f"id {kind}, deviation long, w array<double>")
    return white.select("id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
