"""Exact medians of whole columns without one buffer of all values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.scratch import Scratch

CELLS = 4096


def exact_medians(counts: DataFrame) -> dict[str, float]:
    """The median of every name of ``counts`` (name, value, n: how often).

    The range that holds a middle value is cut in 4,096 per pass until one value
    is left, for all names at once: the driver sees at most that many counts for
    each of a name's two middle values, and no task holds a column. Null values
    do not count; a name without values has no entry.
    """

    spark = counts.sparkSession
    rows = Scratch(spark, "medians").write(
        counts.where("value IS NOT NULL").groupBy("name", "value").agg(F.sum("n").alias("n")), "counts")
    todo: dict[tuple[str, int], list] = {}
    for r in rows.groupBy("name").agg(F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect():
        for rank in {(r.n + 1) // 2, r.n // 2 + 1}:
            todo[r["name"], rank] = [float(r.lo), float(r.hi), rank]  # range, rank within it
    while any(lo < hi for lo, hi, _ in todo.values()):
        states = spark.createDataFrame(
            [(name, rank, lo, hi) for (name, rank), (lo, hi, _) in todo.items() if lo < hi], "name string, rank long, lo double, hi double")
        cell = F.expr(f"IF((hi - lo) / {CELLS} > 0, least(floor((value - lo) / ((hi - lo) / {CELLS})), {CELLS - 1}), value)")
        found = rows.join(F.broadcast(states), "name").where("value BETWEEN lo AND hi").groupBy("name", "rank", cell.alias("cell")).agg(
            F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).orderBy("name", "rank", "lo").collect()
        settled = set()
        for r in found:
            key = (r["name"], r["rank"])
            if key in settled:
                continue
            state = todo[key]
            if state[2] <= r.n:
                todo[key] = [float(r.lo), float(r.hi), state[2]]
                settled.add(key)
            else:
                state[2] -= r.n
    middle: dict[str, list[float]] = {}
    for (name, _), (lo, _, _) in sorted(todo.items()):
        middle.setdefault(name, []).append(lo)
    return {name: (v[0] + v[-1]) / 2 for name, v in middle.items()}
