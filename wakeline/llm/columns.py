"""Columns under numbered names, so that helper columns cannot clash with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns called c0, c1, ..."""

    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def number_of(docs: DataFrame, column: str) -> str:
    """What ``numbered`` calls ``column``."""

    return f"c{docs.columns.index(column)}"


def restored(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``out``, where they are numbered."""

    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
