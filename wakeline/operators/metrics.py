"""Evaluation tables from (label, prediction) rows: all are counts of
(label, prediction) pairs — a tiny aggregate — turned into per-class and
per-pair metrics, so the work is one map-side combined groupBy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import haversine_sql

CALIBRATION_BINS = 10


def pair_counts(rows: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return rows.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(F.expr("count(1) AS n"))


def class_counts(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.groupBy(F.col(label).alias("class")).agg(F.expr("count(1) AS rows"))


def class_metrics(rows: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class (0 on zero division), over
    the union of labels and predictions."""

    pc = pair_counts(rows, label, pred)
    support = pc.groupBy(F.col("actual").alias("class")).agg(F.expr("sum(n) AS support"))
    predicted = pc.groupBy(F.col("predicted").alias("class")).agg(F.expr("sum(n) AS predicted"))
    tp = pc.where("actual = predicted").selectExpr("actual AS class", "n AS tp")
    j = support.join(predicted, "class", "full_outer").join(tp, "class", "left")
    return j.selectExpr(
        "class",
        "CASE WHEN coalesce(predicted, 0) = 0 THEN 0.0D ELSE coalesce(tp, 0) / predicted END AS precision",
        "CASE WHEN coalesce(support, 0) = 0 THEN 0.0D ELSE coalesce(tp, 0) / support END AS recall",
        "CAST(coalesce(support, 0) AS BIGINT) AS support",
    ).selectExpr(
        "class", "precision", "recall",
        "CASE WHEN precision + recall = 0 THEN 0.0D ELSE 2.0D * precision * recall / (precision + recall) END AS f1_score",
        "support",
    )


def summary_metrics(rows: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row: accuracy, macro F1, weighted F1."""

    cm = class_metrics(rows, label, pred)
    acc = rows.agg(F.expr(f"avg(CASE WHEN {label} = {pred} THEN 1.0D ELSE 0.0D END) AS accuracy"))
    f1 = cm.agg(
        F.expr("avg(f1_score) AS macro_f1"),
        F.expr("sum(f1_score * support) / sum(support) AS weighted_f1"),
    )
    return acc.crossJoin(f1)


def confusion_pairs(rows: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Off-diagonal (actual, predicted) counts with the actual class support
    and error rate (count / support)."""

    pc = pair_counts(rows, label, pred)
    sup = pc.groupBy("actual").agg(F.expr("sum(n) AS actual_support"))
    return pc.where("actual <> predicted").join(sup, "actual").selectExpr(
        "actual", "predicted", "n AS count", "actual_support", "n / actual_support AS actual_error_rate"
    )


def top_confusions(rows: DataFrame, n: int = 10, label: str = "label", pred: str = "prediction") -> DataFrame:
    return confusion_pairs(rows, label, pred).orderBy(
        F.col("count").desc(), F.col("actual"), F.col("predicted")
    ).limit(int(n))


def confusion_matrix(rows: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Full matrix in long form with row percentages: diagonal = support − errors."""

    pc = pair_counts(rows, label, pred)
    classes = pc.selectExpr("actual AS c").unionByName(pc.selectExpr("predicted AS c")).distinct()
    grid = classes.selectExpr("c AS actual").crossJoin(F.broadcast(classes.selectExpr("c AS predicted")))
    sup = pc.groupBy("actual").agg(F.expr("sum(n) AS support"))
    return grid.join(pc, ["actual", "predicted"], "left").join(sup, "actual", "left").selectExpr(
        "actual", "predicted", "coalesce(n, 0) AS count",
        "CASE WHEN coalesce(support, 0) = 0 THEN 0.0D ELSE 100.0D * coalesce(n, 0) / support END AS row_pct",
    )


def calibration_error(rows: DataFrame, label: str = "label", pred: str = "prediction",
                      confidence: str = "confidence", bins: int = CALIBRATION_BINS) -> DataFrame:
    """Expected calibration error over ``bins`` equal-width confidence bins
    (the last bin closed): sum over bins of |accuracy − mean confidence| ·
    share of rows. One row (``ece``) plus per-bin detail is in ``calibration_bins``."""

    b = calibration_bins(rows, label, pred, confidence, bins)
    return b.agg(F.expr("sum(abs(accuracy - mean_confidence) * rows) / sum(rows) AS ece"))


def calibration_bins(rows: DataFrame, label: str = "label", pred: str = "prediction",
                     confidence: str = "confidence", bins: int = CALIBRATION_BINS) -> DataFrame:
    binned = rows.selectExpr(
        f"least(CAST(floor({confidence} * {bins}) AS INT), {bins - 1}) AS bin",
        f"CASE WHEN {label} = {pred} THEN 1.0D ELSE 0.0D END AS hit",
        f"{confidence} AS conf",
    )
    return binned.groupBy("bin").agg(
        F.expr("count(1) AS rows"), F.expr("avg(hit) AS accuracy"), F.expr("avg(conf) AS mean_confidence")
    )


def horizon_error(rows: DataFrame, horizons, pred_prefix: str) -> DataFrame:
    """Mean haversine km and lat/lon MAE (degrees) per horizon, long form."""

    means, parts = [], []
    for h in horizons:
        d = haversine_sql(f"target_lat_{h}h", f"target_lon_{h}h", f"{pred_prefix}lat_{h}h", f"{pred_prefix}lon_{h}h")
        means += [F.expr(f"avg({d}) AS km_{h}"), F.expr(f"avg(abs(target_lat_{h}h - {pred_prefix}lat_{h}h)) AS la_{h}"),
                  F.expr(f"avg(abs(target_lon_{h}h - {pred_prefix}lon_{h}h)) AS lo_{h}")]
        parts.append(f"named_struct('horizon_h', {int(h)}, 'mean_error_km', km_{h}, 'mae_lat', la_{h}, 'mae_lon', lo_{h})")
    return rows.agg(*means).selectExpr(f"inline(array({', '.join(parts)}))")


def error_reduction_pct_sql(base: str, model: str) -> str:
    return f"CASE WHEN {base} IS NULL OR {model} IS NULL OR {base} <= 0 THEN NULL ELSE ({base} - {model}) / {base} * 100.0D END"
