"""Small numeric helpers shared by the operators and the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


# Fixed value: the rounding boundary sits at 0.5000153 units instead of 0.5.
# Means of fixed-precision inputs (positions in micro-degrees, speeds in
# 1/100 kn) often land *exactly* on a decimal midpoint, where a 1-ulp
# difference from summation order flips a half-up rounding. The shifted
# boundary cannot be hit by such a mean of fewer than 10^7 values, so the
# rounded result no longer depends on partitioning or engine.
ROUND_OFFSET = 0.4999847


def round_half_up(c, digits: int = 6) -> Column:
    """``floor(x * 10^d + 0.4999847) / 10^d``: quantise to ``d`` decimals the
    same way in every IEEE engine, independent of summation order."""

    x = F.col(c) if isinstance(c, str) else c
    scale = float(10**digits)
    return (F.floor(x * scale + ROUND_OFFSET) / scale).cast("double")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column so results compare across engines."""

    scale = f"{float(10**digits)}D"
    return df.selectExpr(
        *[
            f"CAST(floor(`{f.name}` * {scale} + {ROUND_OFFSET}D) / {scale} AS DOUBLE) AS `{f.name}`"
            if isinstance(f.dataType, (DoubleType, FloatType))
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def bround_int(x) -> Column:
    """Python ``round`` (half to even) to an integer, as a bigint."""

    c = F.col(x) if isinstance(x, str) else x
    return F.bround(c, 0).cast("bigint")
