"""Exact quantiles of many groups at once, however large one of them is.

Values are counted by (group, value) first. Every wanted rank of every group is a
row of a table: the range of values that holds it, and its rank within the range.
A round cuts all open ranges into ``CELLS`` cells, counts them with a map-side
combine, and keeps the cell that holds the rank; it ends with the value itself.
No task holds a group's values, and the driver only learns whether a range is
still open. The rounds follow the ratio of a range to the gap between its values:
two to four for measurements.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wakeline.scratch import Scratch

CELLS = 4096


def grouped_quantiles(values: DataFrame, keys: Sequence[str], quantiles: Sequence[float], value: str = "value") -> DataFrame:
    """(keys, q, value): each quantile of each group, interpolated between the two
    ranks around it (as ``percentile`` does). Keys hold no nulls; values that are
    null or NaN do not count, and a group without values has no row."""

    scratch = Scratch(values.sparkSession, "quantiles")
    counts = scratch.write(values.selectExpr(*keys, f"CAST({value} AS DOUBLE) AS v").where("v IS NOT NULL AND NOT isnan(v)").groupBy(*keys, "v").agg(
        F.count("*").alias("n")), "counts")
    wanted = ", ".join(f"{float(q)!r}D" for q in quantiles)
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    asked = scratch.write(totals.selectExpr(*keys, "n", "lo", "hi", f"explode(array({wanted})) AS q").selectExpr(
        *keys, "q", "lo", "hi", "(n - 1) * q AS at").selectExpr("*", "CAST(floor(at) AS BIGINT) AS low", "CAST(ceil(at) AS BIGINT) AS high"), "asked")
    state = asked.selectExpr(*keys, "lo", "hi", "explode(array_distinct(array(low, high))) AS rank").distinct().withColumn("left", F.col("rank"))
    state = scratch.write(state, "state")
    while not state.where("lo < hi").isEmpty():
        open_ = state.where("lo < hi")
        cell = F.expr(f"IF((hi - lo) / {CELLS} > 0, least(floor((v - lo) / ((hi - lo) / {CELLS})), {CELLS - 1}), v)")
        cells = counts.join(open_, list(keys)).where("v BETWEEN lo AND hi").groupBy(*keys, "rank", "left", cell.alias("cell")).agg(
            F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(W.partitionBy(*keys, "rank").orderBy("lo").rowsBetween(W.unboundedPreceding, 0))  # CELLS rows at most
        held = cells.withColumn("upto", upto).where("upto > left AND upto - n <= left").selectExpr(*keys, "lo", "hi", "rank", "left - (upto - n) AS left")
        new = scratch.write(state.where("lo = hi").unionByName(held), "state")
        scratch.drop(state)
        state = new
    found = state.select(*keys, "rank", "lo")
    low, high = (found.withColumnRenamed("rank", side).withColumnRenamed("lo", f"v_{side}") for side in ("low", "high"))
    return asked.select(*keys, "q", "at", "low", "high").join(low, [*keys, "low"]).join(high, [*keys, "high"]).selectExpr(
        *keys, "q", "IF(low = high, v_low, (high - at) * v_low + (at - low) * v_high) AS value")
