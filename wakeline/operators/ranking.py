"""Row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wakeline.scratch import Scratch


def global_row_number(df: DataFrame, order: Sequence[str], column: str, start: int = 1) -> DataFrame:
    """``df`` with its row numbers in the order of the SQL expressions
    ``order``. Rows are dealt into ranges and numbered inside each; one count for
    each range is what meets in one task."""

    keys = [F.expr(o) for o in order]
    ranged = Scratch(df.sparkSession, "rank").write(
        df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    before = ranged.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(*keys))
    return ranged.join(F.broadcast(before), "_part").withColumn(column, F.col("_before") + inside + (start - 1)).drop("_part", "_before")
