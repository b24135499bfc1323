"""SimHash near-dedup over BK-trees.

Fingerprint: words are runs of anything but ASCII space, tab, line feed,
vertical tab, form feed and carriage return; A-Z is lower-cased; shingles are
``shingle`` words (repeats count; a shorter text is one shingle; no words give
fingerprint zero). Each shingle is hashed with XXH64 (seed 42); a bit of the
fingerprint is 1 if it is set in over half of the hashes.

Linking: fingerprints of equal value are merged first. The 64 bits are cut in
``distance + 2`` blocks; two fingerprints within ``distance`` bits agree on two
blocks at least, so each distinct fingerprint goes to one shard for each pair
of blocks, keyed by the bits of those two. Every shard is a BK-tree, delivered
to the task that holds the shard's queries. A shard of more than ``shard_rows``
fingerprints is dealt into several trees of about that size, and each of its
fingerprints searches its own and the lower-numbered trees; so nothing is
capped, no task holds more than a bounded tree at a time, and no link is lost.
Tasks return a spanning forest of the links they found; components come from
contraction.

Nulls and ties: a null text has no words. A null id is an ordinary row, but
never names a component unless all ids in it are null. Rows that repeat an id
each get a fingerprint. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.batches import spanning
from wakeline.llm.bktree import Forest
from wakeline.llm.columns import number_of, numbered, restored
from wakeline.operators.components import connected_components
from wakeline.scratch import Scratch

SHINGLE = 3
DISTANCE = 3
SHARD_ROWS = 4096
HASH_SEED = 42
_CHUNK = 1 << 16  # shingles whose bits are counted at a time
_FLUSH = 1 << 16  # fingerprints whose trees are searched at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of one text."""

    from xxhash import xxh64_digest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return int.from_bytes(xxh64_digest(b" ".join(words), HASH_SEED), "big")
    total, n = np.zeros(64, dtype=np.int64), len(words) - shingle + 1
    for at in range(0, n, _CHUNK):
        part = words[at: at + _CHUNK + shingle - 1]
        raw = b"".join([xxh64_digest(b" ".join(t), HASH_SEED) for t in zip(*(part[i:] for i in range(shingle)))])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, fp) for every row; fp is the fingerprint as a signed
    long, text_hash Spark's xxhash64 of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["id", "text_hash", "fp"])

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _masks(distance: int) -> list[int]:
    """For each pair of blocks the mask of their bits, as a signed long."""

    blocks = distance + 2
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    signed = [x | y for x, y in combinations(block, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in signed]


def _search(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (t, v, s, fp, own) sorted by shard; emits a spanning forest of the
    links, a bounded number of whole shards at a time."""

    names = ("t", "v", "s", "fp", "own")

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def links(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        new = np.r_[True, (rows["t"][1:] != rows["t"][:-1]) | (rows["v"][1:] != rows["v"][:-1]) | (rows["s"][1:] != rows["s"][:-1])]
        group = np.cumsum(new) - 1
        keep = np.bincount(group)[group] > 1
        group, fp, own = group[keep], rows["fp"][keep].astype(np.int64).view(np.uint64), rows["own"][keep].astype(bool)
        if not len(fp):
            return
        forest = Forest(fp[own], group[own])
        has = np.array(sorted(forest.roots), dtype=np.int64)
        root = np.array([forest.roots[g] for g in has.tolist()], dtype=np.int64)
        at = np.searchsorted(has, group)
        ok = (at < len(has)) & (has[np.minimum(at, len(has) - 1)] == group)
        fp, at = fp[ok], at[ok]
        a, b = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        for i in range(0, len(fp), 2048):
            q, p = forest.search(fp[i: i + 2048], root[at[i: i + 2048]], distance)
            x, y = fp[i: i + 2048][q], forest.points[p]
            ne = x != y
            a, b = spanning(np.concatenate([a, x[ne]]), np.concatenate([b, y[ne]]))
        if len(a):
            yield out(a, b)

    held: dict[str, np.ndarray] = {k: np.zeros(0, dtype=np.int64) for k in names}
    for batch in batches:
        held = {k: np.concatenate([held[k], batch.column(k).to_numpy(zero_copy_only=False)]) for k in names}
        n = len(held["fp"])
        if n < _FLUSH:
            continue
        last = np.flatnonzero((held["t"] != held["t"][-1]) | (held["v"] != held["v"][-1]) | (held["s"] != held["s"][-1]))
        if len(last):
            cut = int(last[-1]) + 1
            yield from links({k: x[:cut] for k, x in held.items()})
            held = {k: x[cut:] for k, x in held.items()}
    if len(held["fp"]):
        yield from links(held)


def links(fps: DataFrame, distance: int = DISTANCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``fps`` (one
    column fp, distinct) that differ in ``distance`` bits or fewer."""

    shards = F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(_masks(distance))
    ]))
    rows = fps.select("fp", shards.alias("k")).select("fp", "k.t", "k.v")
    big = rows.groupBy("t", "v").count().filter(F.col("count") > shard_rows).select(
        "t", "v", F.ceil(F.col("count") / shard_rows).alias("trees"))
    dealt = rows.join(big, ["t", "v"], "left").withColumn(
        "mine", F.expr("coalesce(pmod(xxhash64(fp), trees), 0L)")
    ).selectExpr("t", "v", "fp", "mine", "explode(sequence(0L, mine)) AS s").selectExpr("t", "v", "s", "fp", "s = mine AS own")
    placed = dealt.repartition("t", "v", "s").sortWithinPartitions("t", "v", "s")
    return placed.mapInArrow(lambda it: _search(it, distance), "a long, b long")


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int, shard_rows: int) -> tuple[DataFrame, DataFrame]:
    """The table of ``fingerprints`` and (fp, root, low): each fingerprint's
    component and the first row of the component, as struct (id is null, id,
    text_hash), so that nulls come last."""

    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    each = scratch.write(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    row = F.struct(F.col("id").isNull().alias("lost"), "id", "text_hash")
    fps = scratch.write(each.groupBy("fp").agg(F.min(row).alias("low")), "distinct")
    comp = connected_components(spark, links(fps.select("fp"), distance, shard_rows), "simhash-cc")
    rooted = scratch.write(
        fps.join(comp.withColumnRenamed("node", "fp"), "fp", "left").selectExpr("fp", "low", "coalesce(root, fp) AS root"), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("low"))
    return each, scratch.write(rooted.select("fp", "root").join(lowest, "root"), "named")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
    distance: int = DISTANCE, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per document: ``id_col``, fingerprint (signed long ``fp``) and
    component_id, the smallest id reachable over links of ``distance`` bits."""

    each, named = _components(docs, id_col, text_col, shingle, distance, shard_rows)
    return each.join(named, "fp", "left").select(F.col("id").alias(id_col), "fp", F.col("low.id").alias("component_id"))


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
    distance: int = DISTANCE, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The columns of ``docs``, one row for each component: the one with the
    smallest id (nulls last), then the smallest text hash, then row hash."""

    _, named = _components(docs, id_col, text_col, shingle, distance, shard_rows)
    kept = named.select("low.*").distinct().selectExpr("id AS kept_id", "text_hash AS kept_hash")
    rows, key, text = numbered(docs), number_of(docs, id_col), number_of(docs, text_col)
    w = W.partitionBy(key, "text_hash").orderBy(F.xxhash64(*rows.columns))
    first = (
        rows.withColumn("text_hash", F.xxhash64(text))
        .join(kept, F.col(key).eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash")), "left_semi")
        .withColumn("place", F.row_number().over(w)).filter("place = 1")
    )
    return restored(first, docs)
