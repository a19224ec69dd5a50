"""Rank-average blending, weight search and blend scoring.

Predictions are a long frame ``(keys..., id, model, score)``, never
positional arrays.  Weights are a handful of numbers (one per model) applied
as literal coefficients in a fixed order; the simplex weight grid is a parameter-sized literal array
exploded next to each row -- its size is fixed by (models, step), not by the
data -- and every grid point is scored in one grouped-AUC job.
"""
from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rank import grouped_auc, rank_percentile

MIN_GAIN = 0.001
REFINE = (5, 2, 1)   # steps of the refinement in hundredths
AUC_TIE_DIGITS = 9   # AUCs equal to 9 decimals count as ties (first grid point wins)


def normalise_weights(models: Sequence[str], weights: dict[str, float] | None) -> dict[str, float]:
    if weights is None:
        return {m: 1.0 / len(models) for m in models}
    total = sum(weights[m] for m in models)
    return {m: weights[m] / total for m in models}


def rank_average(preds: DataFrame, models: Sequence[str], weights: dict[str, float] | None = None,
                 id_col: str = "alert_id", keys: Sequence[str] = (),
                 model_col: str = "model", score_col: str = "score") -> DataFrame:
    """Weighted mean of per-model rank percentiles: ``(keys..., id, score)``."""
    w = normalise_weights(models, weights)
    pct = rank_percentile(preds.where(F.col(model_col).isin(list(models))),
                          [*keys, model_col], score_col, "_pct")
    wide = pct.groupBy(*keys, id_col).pivot(model_col, list(models)).agg(F.first("_pct"))
    # fixed summation order: the blend is ranked again, so it must not depend
    # on the order rows arrive in
    score = F.lit(0.0)
    for m in models:
        score = score + F.lit(float(w[m])) * F.col(m)
    return wide.select(*keys, id_col, score.alias("score"))


def score_blend(preds: DataFrame, labels: DataFrame, models: Sequence[str],
                weights: dict[str, float] | None = None, id_col: str = "alert_id",
                repeat_col: str = "repeat", label: str = "label") -> DataFrame:
    """Blend each repeat's OOF predictions, AUC per repeat: ``(repeat, auc)``."""
    blended = rank_average(preds, models, weights, id_col, keys=[repeat_col])
    return grouped_auc(blended.join(labels.select(id_col, label), id_col),
                       [repeat_col], "score", label).select(repeat_col, "auc")


def simplex_grid(n_models: int, step: float = 0.1) -> list[tuple[float, ...]]:
    """All weight vectors on the simplex with the given step, in lexicographic order."""
    k = int(round(1 / step))
    pts = [c for c in itertools.product(range(k + 1), repeat=n_models) if sum(c) == k]
    return [tuple(x / k for x in c) for c in pts]


def _score_points(wide_pct: DataFrame, models: Sequence[str], label: str,
                  points: Sequence[tuple[float, ...]]) -> DataFrame:
    """AUC of the blend for each weight vector: ``(grid_id, w_<model>..., auc)``."""
    arr = F.array(*[F.struct(F.lit(i).alias("grid_id"),
                             *[F.lit(float(w)).alias(f"w_{m}") for w, m in zip(pt, models)])
                    for i, pt in enumerate(points)])
    exploded = wide_pct.select(label, *models, F.explode(arr).alias("_g"))
    scored = exploded.select(
        label, F.col("_g.grid_id").alias("grid_id"),
        sum((F.col(f"_g.w_{m}") * F.col(m) for m in models), F.lit(0.0)).alias("_blend"))
    aucs = grouped_auc(scored, ["grid_id"], "_blend", label)
    table = wide_pct.sparkSession.createDataFrame(
        [(i, *[float(w) for w in pt]) for i, pt in enumerate(points)],
        "grid_id int, " + ", ".join(f"w_{m} double" for m in models))
    return table.join(aucs.select("grid_id", "auc"), "grid_id")


def weight_grid(wide_pct: DataFrame, models: Sequence[str], label: str = "label",
                step: float = 0.1) -> DataFrame:
    """AUC of the blend for every simplex grid point: ``(grid_id, w_<model>..., auc)``.

    ``wide_pct`` has one rank-percentile column per model and the label."""
    return _score_points(wide_pct, models, label, simplex_grid(len(models), step))


def neighbours(center: Sequence[int], delta: int) -> list[tuple[int, ...]]:
    """Weights in hundredths around ``center`` (itself first): every weight but
    the last moves by -delta, 0 or delta, the last takes up the difference."""
    moved = []
    for move in itertools.product((-delta, 0, delta), repeat=len(center) - 1):
        head = [c + m for c, m in zip(center, move)]
        point = (*head, 100 - sum(head))
        if any(move) and all(0 <= x <= 100 for x in point):
            moved.append(point)
    return [tuple(center), *moved]


def choose_weights(wide_pct: DataFrame, models: Sequence[str], label: str = "label",
                   step: float = 0.1, min_gain: float = MIN_GAIN) -> DataFrame:
    """Fitted weights if they beat equal weights by ``min_gain``.

    The best point of the grid is refined by the steps of ``REFINE``: each
    scores the points around the best one and moves there if the AUC rises.
    One row: ``method, equal_auc, fitted_auc, w_<model>...``."""
    def best_of(scored: DataFrame):
        names = [f"w_{m}" for m in models]
        top = scored.orderBy(F.desc(F.round("auc", AUC_TIE_DIGITS)), "grid_id").first()     # one row
        return tuple(round(100 * top[n]) for n in names), top["auc"]

    point, auc = best_of(weight_grid(wide_pct, models, label, step))
    for delta in REFINE:
        around = [tuple(x / 100 for x in p) for p in neighbours(point, delta)]
        point, auc = best_of(_score_points(wide_pct, models, label, around))
    equal = wide_pct.select(label, (sum((F.col(m) for m in models), F.lit(0.0)) / len(models)).alias("_e"))
    row = grouped_auc(equal, [], "_e", label).select(F.col("auc").alias("equal_auc"))
    use_fit = (F.lit(auc) - F.col("equal_auc")) >= min_gain
    return row.select(
        F.when(use_fit, F.lit("fitted")).otherwise(F.lit("equal")).alias("method"),
        F.col("equal_auc"), F.lit(auc).alias("fitted_auc"),
        *[F.when(use_fit, F.lit(x / 100)).otherwise(F.lit(1.0 / len(models))).alias(f"w_{m}")
          for x, m in zip(point, models)])
