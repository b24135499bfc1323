"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources are ordered by code point (null last) and weigh 1, 2, 3,
repeating. They share all words by weight, except that a source stops at
``repeats`` times its own size; what it leaves is shared among the others by
weight, again and again, until none is above. A source's target is taken as
whole passes over it and the rest from its first documents in the order of a
keyed hash (the last one of these in part), so no document is taken more than
``repeats`` times.

Positions: each weight class has a schedule, a piecewise linear rate over the
training time 0..1. Its integral from 0 is the class's cumulative demand,
scaled so that a source's demand reaches its target at time 1. The words of a
copy of a document begin at some point of the source's demand, and inverting the
demand there gives the time at which training reaches it: a root of a quadratic
in the schedule's segment. Documents are range-sorted by that time.

Hot sources: running sums are taken inside (source, hash bucket) groups and then
over a source's buckets, so no task holds a source. Everything is DataFrame
expressions; the driver sees one row of two sums for each round of resharing.

Defined cases: a null text has size 0, and a document of size 0 is not taken. A
null or unordered source is a source of its own. Rows are ordered by the keyed
hash of id and text, so reruns agree; equal rows may stand in any order, which
leaves the result the same. No rows, or no words at all: all targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wakeline.llm.columns import number_of, numbered, restored
from wakeline.scratch import Scratch

WEIGHTS = (1, 2, 3)
REPEATS = 3
SEED = "mix-1"
BUCKET_DIGITS = 3  # hex digits of the hash: 4,096 buckets a source
WORDS = r"[^\x20\x09-\x0D]+"

#: For each weight class the rate at equally spaced times from 0 to 1: the first
#: class fades out, the second stays level, the third comes in late.
SCHEDULES: tuple[tuple[float, ...], ...] = ((1.5, 1.25, 0.25), (1.0, 1.0, 1.0), (0.25, 1.25, 1.5))


def _row_key(docs: DataFrame) -> Column:
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return F.struct(F.xxhash64(*cols).alias("_k1"), F.hash(*cols).alias("_k2"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, klass, weight, target) from (source, size)."""

    scratch = Scratch(sizes.sparkSession, "mix-targets")
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # The place of a source is its place in its range of names and the number of
    # sources in the ranges before; only these counts meet in one task.
    ranged = scratch.write(
        src.repartitionByRange(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id()), "ranged")
    order = [F.col("source").isNull(), F.col("source")]
    before = ranged.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    placed = ranged.join(before.select("part", F.coalesce("before", F.lit(0)).alias("before")), "part").withColumn(
        "place", F.row_number().over(W.partitionBy("part").orderBy(*order)) + F.col("before"))
    klass = ((F.col("place") - 1) % len(weights)).cast("int")
    table = scratch.write(placed.select(
        "source", "source_size", klass.alias("klass"), F.element_at(F.array(*[F.lit(w) for w in weights]), klass + 1).alias("weight")), "weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    full = F.lit(False)
    stopped = -1
    while True:
        # share = (all words - words of the full sources) / weight of the others
        row = table.agg(
            F.sum(F.when(full, F.col("source_size") * repeats).otherwise(0)).alias("words"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(full, 1).otherwise(0)).alias("n"),
        ).first()
        left, weight, n = total - (row.words or 0), row.weight or 0, row.n or 0
        share = F.lit(float(left)) * F.col("weight") / F.lit(float(weight)) if weight else F.lit(0.0)
        if n == stopped:
            break
        stopped = n
        full = full | (share >= F.col("source_size") * repeats)
    most = (F.col("source_size") * repeats).cast("double")
    return table.select("source", "source_size", "klass", "weight", F.when(full, most).otherwise(share).alias("target"))


def _time(x: Column, klass: Column, schedules: Sequence[Sequence[float]]) -> Column:
    """The time at which a class's normed demand reaches x in 0..1."""

    def invert(rates: Sequence[float]) -> Column:
        step = 1.0 / (len(rates) - 1)
        area = [(a + b) / 2 * step for a, b in zip(rates, rates[1:], strict=False)]
        whole, done = sum(area), 0.0
        out: Column | None = None
        for i, (a, b) in enumerate(zip(rates, rates[1:], strict=False)):
            d = F.greatest(x * F.lit(whole) - F.lit(done), F.lit(0.0))  # demand within the segment
            slope = (b - a) / step
            t = F.lit(i * step) + F.least(
                F.lit(step), d / F.lit(a) if slope == 0 else (F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * d, F.lit(0.0))) - F.lit(a)) / F.lit(slope))
            done += area[i]
            out = F.when(x * F.lit(whole) <= F.lit(done), t) if out is None else out.when(x * F.lit(whole) <= F.lit(done), t)
        return out.otherwise(F.lit(1.0))

    picked = F.when(klass == 0, invert(schedules[0]))
    for k, rates in enumerate(schedules[1:], 1):
        picked = picked.when(klass == k, invert(rates))
    return picked


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, schedules: Sequence[Sequence[float]] = SCHEDULES,
         seed: str = SEED) -> DataFrame:
    """One row per document: id, row_key (two hashes of all columns), source,
    size, source_size, target, taken (words), and copies, an array of (pass,
    words, position), position being the copy's training time in 0..1."""

    scratch = Scratch(docs.sparkSession, "mix")
    sized = scratch.write(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), _row_key(docs).alias("row_key"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))).alias("mark"),
    ).withColumn("bucket", F.substring("mark", 1, BUCKET_DIGITS)), "sizes")
    targets = source_targets(sized, weights, repeats)
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")).withColumn(
        "ahead", F.coalesce(F.sum("bucket_size").over(
            W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    # a bounded number of rows a source: (source, bucket) with the source's figures
    known = scratch.write(buckets.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "ahead").join(
        targets.withColumnRenamed("source", "t"), F.col("s").eqNullSafe(F.col("t"))).drop("t"), "buckets")
    w = W.partitionBy("source", "bucket").orderBy("mark", "id", "size", "row_key").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(w), F.lit(0))).join(
        known, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn("before", F.col("ahead") + F.col("inside"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")
    part = F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), F.col("size"))
    out = placed.withColumn("passes", passes).withColumn("rest", rest).withColumn("part", part).withColumn(
        "taken", F.col("passes") * F.col("size") + F.col("part"))
    copies = F.when(F.col("taken") > 0, F.expr(
        "filter(transform(sequence(0L, passes), k -> struct(k AS pass, IF(k < passes, size, part) AS words,"
        " IF(target > 0, least(1D, (k * source_size + before) / target), 0D) AS reached)), c -> c.words > 0)"))
    times = F.transform(copies, lambda c: F.struct(
        c["pass"].alias("pass"), c["words"].alias("words"), _time(c["reached"], F.col("klass"), schedules).alias("position")))
    return out.select("id", "row_key", "source", "size", "source_size", "target", "taken", times.alias("copies"))


def in_order(planned: DataFrame) -> DataFrame:
    """The documents of a plan, range-sorted by the time at which training first
    reaches them (``position``), those not taken last."""

    first = [F.col("position").isNull(), F.col("position"), F.col("row_key")]
    placed = planned.withColumn("position", F.expr("copies[0].position"))
    return placed.repartitionByRange(*first).sortWithinPartitions(*first)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The copies of ``docs`` that the mix takes, all columns, range-sorted by
    training time: a document once for every pass; where a pass ends inside it,
    that copy has only the words taken, joined by single spaces. Rows equal in
    all columns are planned each and share one text here."""

    rows, text = numbered(docs), number_of(docs, text_col)
    figures = Scratch(docs.sparkSession, "mix-plan").write(
        plan(rows, number_of(docs, id_col), text, number_of(docs, source_col), **how).filter("taken > 0").select(
            F.col("row_key.*"), "size", "copies"), "copies")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({WORDS})"), F.lit(1)), 1, F.col("copy.words").cast("int")), " ")
    keyed = rows.withColumn("key", _row_key(rows)).select(*rows.columns, "key.*")
    once = keyed.withColumn("place", F.row_number().over(W.partitionBy("_k1", "_k2").orderBy("_k1"))).filter("place = 1")
    copies = (
        once.join(figures, ["_k1", "_k2"]).withColumn("copy", F.explode("copies"))
        .repartitionByRange(F.col("copy.position"), F.col("_k1")).sortWithinPartitions(F.col("copy.position"), F.col("_k1"), F.col("copy.pass"))
    )
    return restored(copies.withColumn(text, F.when(F.col("copy.words") < F.col("size"), cut).otherwise(F.col(text))), docs)
