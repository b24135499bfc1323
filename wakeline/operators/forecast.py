"""Position forecast: baselines, horizon errors, the model / dead-reckoning
blend and the per-vessel latest forecast. Model predictions come in as
columns (``<prefix>lat_<h>h``), so the blend works for any regressor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import dead_reckon_sql, haversine_sql
from wakeline.operators.track import latest_position

BLEND_STEPS = 21  # weights 0.00, 0.05, ..., 1.00


def dead_reckoning(rows: DataFrame, horizons: Sequence[int], prefix: str = "dr_") -> DataFrame:
    """Great-circle dead reckoning from each row's position, speed, course."""

    cols = []
    for h in horizons:
        la, lo = dead_reckon_sql("lat", "lon", "sog", "cog", f"{float(h)}D")
        cols += [f"{la} AS {prefix}lat_{h}h", f"{lo} AS {prefix}lon_{h}h"]
    return rows.selectExpr("*", *cols)


def constant_position(rows: DataFrame, horizons: Sequence[int], prefix: str = "const_") -> DataFrame:
    cols = []
    for h in horizons:
        cols += [f"lat AS {prefix}lat_{h}h", f"lon AS {prefix}lon_{h}h"]
    return rows.selectExpr("*", *cols)


def blend_weights(rows: DataFrame, horizons: Sequence[int], model_prefix: str, dr_prefix: str = "dr_") -> DataFrame:
    """Per horizon, the weight w on the model (21 steps 0..1) minimising the
    mean haversine error of ``w * model + (1 - w) * dead_reckoning``; the
    first (smallest) weight wins ties. All horizons and weights are averages of
    one aggregate, so the rows are read once."""

    steps = [i / (BLEND_STEPS - 1) for i in range(BLEND_STEPS)]
    means, best = [], []
    for h in horizons:
        tries = []
        for i, w in enumerate(steps):
            bl_lat = f"({w!r}D * {model_prefix}lat_{h}h + {1.0 - w!r}D * {dr_prefix}lat_{h}h)"
            bl_lon = f"({w!r}D * {model_prefix}lon_{h}h + {1.0 - w!r}D * {dr_prefix}lon_{h}h)"
            means.append(F.expr(f"avg({haversine_sql(f'target_lat_{h}h', f'target_lon_{h}h', bl_lat, bl_lon)}) AS e_{h}_{i}"))
            tries.append(f"named_struct('err', e_{h}_{i}, 'w', {w!r}D)")
        best.append(f"named_struct('horizon_h', {int(h)}, 'best', array_min(array({', '.join(tries)})))")
    return rows.agg(*means).selectExpr(f"inline(array({', '.join(best)}))").selectExpr(
        "horizon_h", "best.w AS weight", "best.err AS error_km")


def prediction_method_sql(weight: str) -> str:
    return (
        f"CASE WHEN {weight} <= 0.0D THEN 'dead_reckoning' WHEN {weight} >= 1.0D THEN 'random_forest'"
        " ELSE 'rf_dead_reckoning_blend' END"
    )


def apply_blend(rows: DataFrame, weights: DataFrame, horizons: Sequence[int], model_prefix: str,
                dr_prefix: str = "dr_", out_prefix: str = "pred_") -> DataFrame:
    """Blend with the per-horizon weights (missing weight → 1.0). The
    weight table has one row per horizon: it is pivoted to one row and
    broadcast."""

    wrow = weights.agg(*[F.expr(f"max(CASE WHEN horizon_h = {h} THEN weight END) AS _w{h}") for h in horizons])
    j = rows.crossJoin(F.broadcast(wrow))
    cols = []
    for h in horizons:
        w = f"coalesce(_w{h}, 1.0D)"
        cols += [
            f"{w} * {model_prefix}lat_{h}h + (1.0D - {w}) * {dr_prefix}lat_{h}h AS {out_prefix}lat_{h}h",
            f"{w} * {model_prefix}lon_{h}h + (1.0D - {w}) * {dr_prefix}lon_{h}h AS {out_prefix}lon_{h}h",
            f"{w} AS rf_weight_{h}h",
            f"{prediction_method_sql(w)} AS prediction_method_{h}h",
        ]
    return j.selectExpr(*rows.columns, *cols)


def clip_columns(rows: DataFrame, horizons: Sequence[int], prefixes: Sequence[str]) -> DataFrame:
    """Clip forecast latitudes to [-90, 90] and longitudes to [-180, 180]."""

    repl = {}
    for p in prefixes:
        for h in horizons:
            repl[f"{p}lat_{h}h"] = f"least(greatest({p}lat_{h}h, -90.0D), 90.0D) AS {p}lat_{h}h"
            repl[f"{p}lon_{h}h"] = f"least(greatest({p}lon_{h}h, -180.0D), 180.0D) AS {p}lon_{h}h"
    return rows.selectExpr(*[repl.get(c, f"`{c}`") for c in rows.columns])


def forecast_latest(points: DataFrame, weights: DataFrame, horizons: Sequence[int], model_prefix: str,
                    mean_error_km: DataFrame | None = None) -> DataFrame:
    """Latest point per vessel → blended forecast per horizon with the
    model, dead-reckoning and blended positions clipped, weight and method.
    ``points`` must carry the model's predicted columns."""

    latest = latest_position(points)
    dr = dead_reckoning(latest, horizons, "dead_reckoning_pred_")
    blended = apply_blend(dr, weights, horizons, model_prefix, "dead_reckoning_pred_", "pred_")
    out = blended.selectExpr(
        "mmsi", "ts AS start_timestamp", "lat AS start_lat", "lon AS start_lon",
        *[c for h in horizons for c in (
            f"pred_lat_{h}h", f"pred_lon_{h}h", f"{model_prefix}lat_{h}h AS rf_pred_lat_{h}h",
            f"{model_prefix}lon_{h}h AS rf_pred_lon_{h}h", f"dead_reckoning_pred_lat_{h}h",
            f"dead_reckoning_pred_lon_{h}h", f"rf_weight_{h}h", f"prediction_method_{h}h",
        )],
    )
    out = clip_columns(out, horizons, ("pred_", "rf_pred_", "dead_reckoning_pred_"))
    if mean_error_km is not None:
        out = out.crossJoin(F.broadcast(mean_error_km.agg(F.expr("avg(mean_error_km) AS mean_error_km"))))
    return out
