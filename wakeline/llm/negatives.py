"""Hard-negative mining with Four-Russians scoring.

Components become integers (``floor(SCALE * x)``). A candidate's components,
counted from the smallest of the table, are cut into bit planes, and each plane
is packed to one byte for every eight dimensions. For an anchor and a group of
eight dimensions a table holds the sums of all 256 subsets of its eight
components; a candidate's byte is the place to look. Adding the looked-up sums of
a plane and shifting from plane to plane gives the inner product, exactly.

Anchors meet all rows in blocks: both are dealt by the hash of a row number into
blocks of bounded size, and each pair of blocks is a group of its own, so no
group grows with the table, with a label or with copies of a row. A first round
finds the positives of each anchor (the best rows of its own label), a second
one the rows of other labels whose score lies between two shares of a positive's
score. A group returns only the best few of each anchor; these meet by anchor.

Rows with a null label, a null vector, or a null or non-finite component take no
part. Scaled components beyond 2^26 count as 2^26. Vectors of different length
(also empty ones, which all score 0) are never compared. Scores tie by the
smaller id, null ids last. A null id is an ordinary row, but no anchor where the
anchor rule is null. Rows that repeat an id are rows of their own: an anchor row
is not compared with itself but with its copies, and copies of an anchor have
results of their own. Only the three columns and the anchor rule are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wakeline.scratch import Scratch

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # per cent of the positive's score
TABLE_ANCHORS, PIECE = 512, 512
FOUND = "anchor long, slot int, score long, id {id}, uid long"


def subset_sums(x: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for every eight components of each row of ``x``
    the sums of their subsets; bit i of the place stands for component i."""

    rows, dim = x.shape
    groups = -(-dim // 8)
    padded = np.zeros((rows, groups * 8), dtype=x.dtype)
    padded[:, :dim] = x
    parts = padded.reshape(rows, groups, 8).transpose(1, 2, 0)
    out = np.zeros((groups, 256, rows), dtype=x.dtype)
    for i in range(8):
        out[:, 1 << i: 2 << i] = out[:, : 1 << i] + parts[:, i, None, :]
    return out


def bit_planes(x: np.ndarray, low: int, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes of ``x - low``, the highest plane first."""

    u = x.astype(np.int64) - low
    bits = (u[:, None, :] >> np.arange(planes - 1, -1, -1)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


class Scorer:
    """Inner products of a block of anchors with rows given as bit planes."""

    def __init__(self, anchors: np.ndarray, low: int, planes: int):
        reach = int(np.abs(anchors).sum(axis=1).max(initial=0)) * ((1 << planes) + abs(low))
        self.kind = np.int32 if reach < 1 << 30 else np.int64
        self.sums = subset_sums(anchors.astype(self.kind))
        self.base = (anchors.sum(axis=1) * low).astype(self.kind)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """(rows, anchors) scores."""

        total = np.zeros((len(codes), len(self.base)), dtype=self.kind)
        found = np.empty_like(total)
        for plane in range(codes.shape[1]):
            total += total
            for group, sums in enumerate(self.sums):
                np.take(sums, codes[:, plane, group], axis=0, out=found, mode="clip")
                total += found
        total += self.base
        return total


class Best:
    """The best ``k`` (score, place) of each of ``n`` anchors, of places that
    come in rising order; equal scores keep the earlier place."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.place = np.full((n, k), -1)

    def add(self, scores: np.ndarray, valid: np.ndarray, at: int) -> None:
        """Scores (rows, anchors) of the rows at places ``at`` and on."""

        least = self.score[:, -1]
        enter = valid & (scores > least)
        if enter.sum() > 4 * self.k * scores.shape[1] and len(scores) > self.k:
            masked = np.where(enter, scores, np.iinfo(scores.dtype).min)
            enter &= scores >= np.partition(masked, len(scores) - self.k, axis=0)[len(scores) - self.k]
        row, anchor = np.nonzero(enter)
        if not len(row):
            return
        touched = np.unique(anchor)
        a = np.concatenate([np.repeat(touched, self.k), anchor])
        s = np.concatenate([self.score[touched].ravel(), scores[row, anchor].astype(np.int64)])
        p = np.concatenate([self.place[touched].ravel(), row + at])
        by = np.lexsort((p, ~s, a))  # ~s falls as s rises
        a, s, p = a[by], s[by], p[by]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        top = rank < self.k
        self.score[a[top], rank[top]], self.place[a[top], rank[top]] = s[top], p[top]


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _meet(low: int, planes: int, k: int, negatives: bool):
    """Anchors (uid, label, x, positives) against candidates (uid, id, label,
    codes) of one pair of blocks: rows of FOUND."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("id", "ascending"), ("uid", "ascending")], null_placement="at_end"))
        labels = pc.dictionary_encode(pa.chunked_array([*anchors.column("label").chunks, *rows.column("label").chunks])).combine_chunks()
        code = labels.indices.to_numpy(zero_copy_only=False) if isinstance(labels, pa.DictionaryArray) else np.zeros(0, dtype=int)
        mine, theirs = code[: len(anchors)], code[len(anchors):]
        own, uid = anchors.column("uid").to_numpy(), rows.column("uid").to_numpy()
        out = []
        if len(anchors) and len(rows):
            x = _matrix(anchors.column("x"), np.int64)
            groups = -(-x.shape[1] // 8)
            codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), dtype=np.uint8).reshape(len(rows), planes, groups)
            if negatives:
                goals = anchors.column("positives").to_pylist()
                for at in range(0, len(own), TABLE_ANCHORS):
                    out += _negatives(Scorer(x[at: at + TABLE_ANCHORS], low, planes), codes, mine[at: at + TABLE_ANCHORS], theirs, goals[at: at + TABLE_ANCHORS], k, own[at: at + TABLE_ANCHORS])
            else:
                for label in np.unique(mine).tolist():
                    same, seen = np.flatnonzero(mine == label), np.flatnonzero(theirs == label)
                    for at in range(0, len(same) if len(seen) else 0, TABLE_ANCHORS):
                        some = same[at: at + TABLE_ANCHORS]
                        out += _positives(Scorer(x[some], low, planes), codes, seen, uid, own[some], k)
        slots, scores, places, of = (np.concatenate(c) if out else np.zeros(0, dtype=np.int64) for c in (zip(*out, strict=True) if out else ((),) * 4))
        picked = rows.take(pa.array(places.astype(np.int64)))
        return pa.table({
            "anchor": pa.array(of.astype(np.int64)), "slot": pa.array(slots.astype(np.int32)), "score": pa.array(scores.astype(np.int64)),
            "id": picked.column("id"), "uid": picked.column("uid")})

    return run


def _rows_of(best: Best, slot: int, own: np.ndarray, places: np.ndarray | None = None) -> tuple:
    anchor, rank = np.nonzero(best.place >= 0)
    place = best.place[anchor, rank]
    return np.full(len(anchor), slot), best.score[anchor, rank], place if places is None else places[place], own[anchor]


def _positives(score: Scorer, codes: np.ndarray, seen: np.ndarray, uid: np.ndarray, own: np.ndarray, k: int) -> list[tuple]:
    best = Best(len(own), k)
    for at in range(0, len(seen), PIECE):
        piece = seen[at: at + PIECE]
        best.add(score(codes[piece]), uid[piece][:, None] != own[None, :], at)
    return [_rows_of(best, 0, own, seen)]


def _negatives(score: Scorer, codes: np.ndarray, mine: np.ndarray, theirs: np.ndarray, goals: list, k: int, own: np.ndarray) -> list[tuple]:
    """``goals``: for each anchor the score of each of its positives."""

    slots = max((len(g or ()) for g in goals), default=0)
    none = (1, 0)  # an empty range
    bound = np.array([[(-(-LEAST * g[j] // 100), MOST * g[j] // 100) if g and j < len(g) else none for g in goals] for j in range(slots)], dtype=np.int64)
    best = [Best(len(mine), k) for _ in range(slots)]
    for at in range(0, len(codes), PIECE):
        s = score(codes[at: at + PIECE])
        other = theirs[at: at + PIECE, None] != mine[None, :]
        for j in range(slots):
            best[j].add(s, other & (s >= bound[j, :, 0]) & (s <= bound[j, :, 1]), at)
    return [_rows_of(b, j, own) for j, b in enumerate(best)]


def _blocks(n: int, least: int, share: int, most: int) -> int:
    """Number of blocks of between ``least`` and ``most`` rows, ``share`` or
    fewer of them while that keeps them below ``most``."""

    return max(1, -(-n // min(max(n // share, least), most)))


def mine(
    table: DataFrame, anchor: str, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); ``anchor`` is the SQL condition for anchor rows."""

    spark = table.sparkSession
    scratch = Scratch(spark, "negatives")
    value = f"CAST(least(greatest(floor({SCALE} * CAST(c AS DOUBLE)), -67108864), 67108864) AS INT)"
    vector = f"`{vector_col}`"
    sound = f"`{label_col}` IS NOT NULL AND {vector} IS NOT NULL AND forall({vector}, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))"
    rows = scratch.write(table.filter(sound).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.expr(f"transform({vector}, c -> {value})").alias("x"),
        F.coalesce(F.expr(anchor), F.lit(False)).alias("anchor"), F.size(vector).alias("dim"), F.monotonically_increasing_id().alias("uid")), "rows")
    kind = rows.schema["id"].dataType.simpleString()
    n, queries, low, high = rows.agg(F.count("*"), F.count_if("anchor"), F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    low, high = low or 0, high or 0
    planes = max(1, (high - low).bit_length())
    many, few = _blocks(n, 2048, 256, 65_536), _blocks(queries, 1024, 16, 16_384)

    def pack(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = part.column("x").flatten().to_numpy().reshape(part.num_rows, dim)
                codes = bit_planes(x, low, planes).reshape(part.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("uid", "id", "label", "dim")), pa.array([c.tobytes() for c in codes], pa.binary())],
                    names=["uid", "id", "label", "dim", "codes"])

    label = rows.schema["label"].dataType.simpleString()
    candidates = rows.select("uid", "id", "label", "dim", "x").mapInArrow(pack, f"uid long, id {kind}, label {label}, dim int, codes binary").withColumns(
        {"cb": F.expr(f"pmod(xxhash64(uid), {many}L)"), "ab": F.explode(F.expr(f"sequence(0L, {few - 1}L)"))})

    def found(anchors: DataFrame, k: int, other: bool) -> DataFrame:
        spread = anchors.withColumns({"ab": F.expr(f"pmod(xxhash64(uid), {few}L)"), "cb": F.explode(F.expr(f"sequence(0L, {many - 1}L)"))})
        each = spread.groupBy("dim", "ab", "cb").cogroup(candidates.groupBy("dim", "ab", "cb")).applyInArrow(
            _meet(low, planes, k, other), FOUND.format(id=kind))
        rank = F.row_number().over(W.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "uid"))
        return each.withColumn("rank", rank).filter(F.col("rank") <= k)

    anchors = rows.filter("anchor").select("uid", "id", "label", "dim", "x")
    best = scratch.write(found(anchors.select("uid", "label", "dim", "x"), positives, False), "positives")
    goals = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p")).select(
        F.col("anchor").alias("uid"), F.expr("transform(p, s -> s.score)").alias("positives"))
    hard = found(anchors.select("uid", "label", "dim", "x").join(goals, "uid"), negatives, True)
    names = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    pairs = best.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(names, "anchor").join(hard, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
