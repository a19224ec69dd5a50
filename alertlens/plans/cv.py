"""Repeated stratified cross-validation on Spark ML (M5, M6).

* folds: ``stratified_folds`` (md5-ranked, distributed);
* imputation is fitted on each fold's training part only, and all
  ``repeats x folds x columns`` exact medians come from a few passes over the
  rows (``blocked.fold_medians``), none of which explodes them to the folds;
* logistic regression: all ``repeats x folds`` models of all candidates are
  fitted side by side (``blocked.fit_blocked``): a pass over the rows gives the
  gradients of all of them.  Every model has the objective
  ``sum loss + ||w_m||^2 / (2 C)`` over its own standardized training rows;
  a shared unpenalized intercept plus penalized per-model offsets stands in
  for per-model unpenalized intercepts;
* other models: the fold models are fitted concurrently from a driver thread
  pool (each fit is its own Spark job);
* predictions stay distributed as one long OOF frame
  ``(alert_id, repeat, fold, score)``;
* per-repeat pooled OOF AUC by ``grouped_auc``; score = mean - std (ddof 0).
"""
from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.folds import N_SPLITS, SEED, stratified_folds
from ..operators.impute import apply_medians
from ..operators.rank import grouped_auc
from ..schema import ALERT_ID, LABEL
from .blocked import Sampled, fit_blocked, fold_medians, oof_scores, with_parts
from .models import Factory, assemble, fit, predict

PARALLEL_FITS = 8


@dataclass(frozen=True)
class CVResult:
    mean: float
    std: float
    repeat_scores: tuple[float, ...]
    oof_per_repeat: DataFrame          # alert_id, repeat, fold, score

    @property
    def score(self) -> float:
        return self.mean - self.std

    @property
    def oof(self) -> DataFrame:
        """Repeat-averaged OOF prediction per alert."""
        return self.oof_per_repeat.groupBy(ALERT_ID).agg(F.avg("score").alias("score"))


def evaluate(factory: Factory, frame: DataFrame, columns: Sequence[str],
             n_repeats: int = 4, label: str = LABEL, parallel: int = PARALLEL_FITS) -> CVResult:
    """Repeated stratified 5-fold CV of ``factory`` on ``frame[columns]``."""
    return evaluate_many(factory, frame, {"_": list(columns)}, n_repeats, label, parallel)["_"]


@dataclass(frozen=True)
class Prepared:
    """Rows with their folds, and the fold medians of columns: the same for all candidates of a search."""

    columns: tuple[str, ...]
    n_repeats: int
    label: str
    folds: DataFrame
    rows: DataFrame
    sampled: Sampled
    medians: dict[tuple[int, int], dict[str, float]]


def prepare(frame: DataFrame, columns: Sequence[str], n_repeats: int = 4, label: str = LABEL) -> Prepared:
    columns = list(dict.fromkeys(columns))
    base = frame.select(ALERT_ID, label, *columns)
    folds = stratified_folds(base, n_repeats=n_repeats, label=label).checkpoint()
    rows = with_parts(base, folds, columns, label, n_repeats)
    sampled = Sampled.of(rows, columns)
    return Prepared(tuple(columns), n_repeats, label, folds, rows, sampled, fold_medians(rows, columns, n_repeats, sampled=sampled))


def evaluate_many(factory: Factory, frame: DataFrame, candidates: dict[str, Sequence[str]],
                  n_repeats: int = 4, label: str = LABEL, parallel: int = PARALLEL_FITS,
                  c_values: dict[str, float] | None = None, prepared: Prepared | None = None) -> dict[str, CVResult]:
    """CV of several candidate column sets (same folds, same fold imputers).

    Logistic regression: every (candidate, repeat, fold) model in ONE fit;
    ``c_values`` optionally gives each candidate its own inverse penalty C.  Other models: one fit
    per (candidate, repeat, fold) from a thread pool.  ``prepared`` is what
    ``prepare`` gave for the same frame, label, repeats and these columns or more."""
    union = list(dict.fromkeys(c for cols in candidates.values() for c in cols))
    base = frame.select(ALERT_ID, label, *union)
    if prepared is None:
        prepared = prepare(frame, union, n_repeats, label)
    elif (prepared.n_repeats, prepared.label) != (n_repeats, label) or not set(union) <= set(prepared.columns):
        raise ValueError("prepared for other columns, repeats or labels")
    rows, folds, medians = prepared.rows, prepared.folds, prepared.medians
    names = list(candidates)

    if factory.name == "logreg":
        fitted = fit_blocked(rows, prepared.columns, medians, float(factory.params.get("C", 1.0)), label,
                             {n: list(candidates[n]) for n in names}, c_values, sampled=prepared.sampled)
        oof = oof_scores(rows, *fitted).checkpoint()
    else:
        keyed = base.join(folds, ALERT_ID).checkpoint()
        sizes = {(r["repeat"], r["fold"]): r["n"] for r in
                 keyed.groupBy("repeat", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
        totals = {r: sum(v for (rr, _), v in sizes.items() if rr == r) for r in range(n_repeats)}

        def run(job):
            name, r, k = job
            cols = list(candidates[name])
            part = keyed.where(F.col("repeat") == r)
            imputed = apply_medians(part, {c: medians[(r, k)][c] for c in cols})
            train = assemble(imputed.where(F.col("fold") != k), cols, keep=(ALERT_ID, label))
            valid = assemble(imputed.where(F.col("fold") == k), cols, keep=(ALERT_ID, label))
            if label != LABEL:
                train = train.withColumnRenamed(label, LABEL)
            model = fit(factory, train, SEED + r, totals[r] - sizes.get((r, k), 0))
            return predict(model, valid, keep=(ALERT_ID,)).select(
                F.lit(name).alias("cand"), ALERT_ID, F.lit(r).alias("repeat"),
                F.lit(k).alias("fold"), "score")

        jobs = [(n, r, k) for n in names for r in range(n_repeats) for k in range(N_SPLITS)]
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            parts = list(pool.map(run, jobs))
        oof = parts[0]
        for p in parts[1:]:
            oof = oof.unionByName(p)
        oof = oof.checkpoint()

    aucs = grouped_auc(oof.join(base.select(ALERT_ID, label), ALERT_ID), ["cand", "repeat"], "score", label)
    rows = aucs.groupBy("cand").agg(
        F.avg("auc").alias("m"), F.stddev_pop("auc").alias("s"),
        F.sort_array(F.collect_list(F.struct("repeat", "auc"))).alias("per")).collect()
    out = {}
    for row in rows:           # one small row per candidate
        per = tuple(float(x["auc"]) for x in row["per"])
        out[row["cand"]] = CVResult(float(row["m"]), float(row["s"]), per,
                                    oof.where(F.col("cand") == row["cand"]).drop("cand"))
    return {n: out[n] for n in names}


def cv_table(results: dict[str, CVResult], spark) -> DataFrame:
    """Metrics table ``(name, cv_mean, cv_std, score)`` of several candidates (M6)."""
    rows = [(k, v.mean, v.std, v.score) for k, v in results.items()]
    return spark.createDataFrame(rows, "name string, cv_mean double, cv_std double, score double")
