"""Seeded random hyper-parameter search judged on mean - std.

The trial parameters come from a seeded generator (log-uniform / integer /
uniform); rounds and step sizes span the reference's ranges.  Each trial is a
2-repeat CV.  Logistic-regression trials differ only in C, so all of
them are scored in ONE blocked fit (see ``cv.evaluate_many``).
"""
from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame

from .cv import evaluate_many
from .models import DEFAULTS, make_factory

SEED = 42

# --- fixed values: search spaces (low, high, kind) ---------------------------
SPACES: dict[str, dict[str, tuple]] = {
    "logreg": {"C": (0.001, 10.0, "log")},
    "gbt": {"maxIter": (300, 1200, "int10"), "stepSize": (0.01, 0.05, "log"), "maxDepth": (2, 6, "int"),
            "minInstancesPerNode": (5, 100, "int"), "subsamplingRate": (0.6, 1.0, "float")},
    "gbt_shallow": {"maxIter": (300, 1200, "int10"), "stepSize": (0.01, 0.05, "log"),
                    "minInstancesPerNode": (5, 100, "int"), "subsamplingRate": (0.6, 1.0, "float")},
    "rf": {"numTrees": (300, 1200, "int10"), "maxDepth": (3, 10, "int"), "minInstancesPerNode": (1, 50, "int")},
}
#: parameters that no trial varies
CONSTANTS: dict[str, dict] = {"gbt": {"featureSubsetStrategy": "0.7"},
                              "gbt_shallow": {"maxDepth": 2, "featureSubsetStrategy": "0.7"},
                              "rf": {"featureSubsetStrategy": "sqrt", "subsamplingRate": 0.8},
                              "logreg": {}}
# -----------------------------------------------------------------------------


def draw_trials(name: str, n_trials: int, seed: int = SEED) -> list[dict]:
    rng = random.Random(seed)
    trials = []
    for _ in range(n_trials):
        p = {}
        for key, (lo, hi, kind) in SPACES[name].items():
            if kind == "log":
                p[key] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            elif kind == "int":
                p[key] = rng.randint(int(lo), int(hi))
            elif kind == "int10":
                p[key] = 10 * rng.randint(int(lo) // 10, int(hi) // 10)
            else:
                p[key] = rng.uniform(lo, hi)
        trials.append(p)
    return trials


def tune(name: str, frame: DataFrame, columns, n_trials: int = 40,
         seed: int = SEED) -> tuple[dict, DataFrame]:
    """Best parameters (with constants merged) and the trials table."""
    trials = draw_trials(name, n_trials, seed)
    cands = {f"t{i}": list(columns) for i in range(len(trials))}
    if name == "logreg":
        results = evaluate_many(make_factory(name, {"C": 1.0}), frame, cands, n_repeats=2,
                                c_values={f"t{i}": t["C"] for i, t in enumerate(trials)})
    else:
        results = {}
        for i, t in enumerate(trials):
            full = {**DEFAULTS[name], **t, **CONSTANTS.get(name, {})}
            results[f"t{i}"] = evaluate_many(make_factory(name, full), frame,
                                             {f"t{i}": list(columns)}, n_repeats=2)[f"t{i}"]
    rows = [(i, str(sorted(t.items())), results[f"t{i}"].mean, results[f"t{i}"].std,
             results[f"t{i}"].score) for i, t in enumerate(trials)]
    best_i = max(range(len(trials)), key=lambda i: (results[f"t{i}"].score, -i))
    spark = frame.sparkSession
    table = spark.createDataFrame(rows, "trial int, params string, cv_mean double, cv_std double, score double")
    best = {**CONSTANTS.get(name, {}), **trials[best_i]}
    if name != "logreg":
        best = {**DEFAULTS[name], **best}
    return best, table
