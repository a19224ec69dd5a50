"""Named classifier registry on Spark ML.

The reference's three boosting libraries collapse to Spark ML trees; its
L2 logistic regression maps to median-impute -> standardize -> logistic
regression with ``regParam = 1 / (C * n)`` (the penalty scaling of the
reference's solver).  Every factory takes a seed; every fit is a Spark job on
the assembled frame, nothing is collected.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ALERT_ID, LABEL

SEED = 42
#: solver limits of the logistic regression in the final fit (cross-validation: see blocked)
MAX_ITER, TOL = 1000, 1e-9
#: boosting rounds and trees of the registered models
ROUNDS = 700
#: seeds of the models that a bag averages
SEEDS = tuple(range(SEED, SEED + 5))

# --- fixed values: default parameters per model -----------------------------
DEFAULTS: dict[str, dict] = {
    "gbt": {"maxIter": ROUNDS, "stepSize": 0.02, "maxDepth": 4, "minInstancesPerNode": 20,
            "subsamplingRate": 0.8, "featureSubsetStrategy": "0.7"},
    "gbt_shallow": {"maxIter": ROUNDS, "stepSize": 0.02, "maxDepth": 2, "minInstancesPerNode": 20,
                    "subsamplingRate": 0.8, "featureSubsetStrategy": "0.7"},
    "rf": {"numTrees": ROUNDS, "maxDepth": 6, "minInstancesPerNode": 10,
           "subsamplingRate": 0.8, "featureSubsetStrategy": "sqrt"},
    "logreg": {"C": 0.1},
}
# ---------------------------------------------------------------------------


def default_params(name: str) -> dict:
    return dict(DEFAULTS[name])


class Factory:
    """``Factory(name, params)(seed)`` -> an unfitted Spark ML estimator
    taking ``features`` (vector) and ``label`` and producing ``probability``."""

    def __init__(self, name: str, params: dict | None = None):
        if name not in DEFAULTS:
            raise KeyError(f"unknown model {name!r}; known: {sorted(DEFAULTS)}")
        self.name = name
        self.params = default_params(name) if params is None else dict(params)

    @property
    def draws(self) -> bool:
        """Whether the fit depends on the seed; the logistic regression samples nothing and starts from zero."""
        return self.name != "logreg"

    def __call__(self, seed: int, n_rows: int):
        """``n_rows`` of the training frame set the penalty of the logistic regression."""
        p = dict(self.params)
        if self.name in ("gbt", "gbt_shallow"):
            return GBTClassifier(featuresCol="features", labelCol=LABEL, seed=seed, **p)
        if self.name == "rf":
            return RandomForestClassifier(featuresCol="features", labelCol=LABEL, seed=seed, **p)
        c, n = float(p.pop("C", 1.0)), max(n_rows, 1)
        # the scaler divides by the sample deviation; the factor turns the
        # penalty into that of population-standardized columns, as in CV
        reg = (n - 1) / n / (c * n) if n > 1 else 1.0 / c
        scaler = StandardScaler(inputCol="features", outputCol="_scaled", withMean=True, withStd=True)
        lr = LogisticRegression(featuresCol="_scaled", labelCol=LABEL, regParam=reg,
                                elasticNetParam=0.0, standardization=False, maxIter=MAX_ITER, tol=TOL)
        return Pipeline(stages=[scaler, lr])


def make_factory(name: str, params: dict | None = None) -> Factory:
    return Factory(name, params)


def assemble(frame: DataFrame, columns: Sequence[str], keep: Sequence[str] = (ALERT_ID, LABEL)) -> DataFrame:
    """``keep`` columns + a ``features`` vector of ``columns`` (already imputed)."""
    va = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep")
    cols = [c for c in keep if c in frame.columns]
    return va.transform(frame.select(*cols, *[F.col(c).cast("double").alias(c) for c in columns])) \
        .select(*cols, "features")


def fit(factory: Factory, train: DataFrame, seed: int, n_rows: int):
    est = factory(seed, n_rows)
    return est.fit(train.withColumn(LABEL, F.col(LABEL).cast("double")))


def predict(model, frame: DataFrame, keep: Sequence[str] = (ALERT_ID,)) -> DataFrame:
    """``keep`` + ``score`` = probability of class 1."""
    out = model.transform(frame)
    return out.select(*[c for c in keep if c in frame.columns],
                      vector_to_array("probability")[1].alias("score"))


def feature_importances(model, columns: Sequence[str]) -> list[tuple[str, float]]:
    """Per-column importances of a fitted tree model (small: one value per column)."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    imp = stage.featureImportances.toArray() if hasattr(stage, "featureImportances") else \
        [abs(x) for x in stage.coefficients.toArray()]
    return list(zip(columns, [float(x) for x in imp]))


def bagged_predict(name: str, params: dict | None, train: DataFrame, test: DataFrame,
                   columns: Sequence[str], seeds: Sequence[int] = SEEDS) -> DataFrame:
    """Fit one model per seed on all of ``train`` (imputed with train medians),
    average the test probabilities per id (B3): ``(alert_id, score)``.

    A model that draws nothing is the same for every seed: it is fitted once."""
    from ..operators.impute import apply_medians, fit_medians
    medians = fit_medians(train, columns)
    tr = assemble(apply_medians(train, medians), columns).checkpoint()
    te = assemble(apply_medians(test, medians), columns, keep=(ALERT_ID,))
    n = tr.count()
    factory = make_factory(name, params)
    distinct = seeds if factory.draws else seeds[:1]
    scored = reduce(DataFrame.unionByName, [predict(fit(factory, tr, s, n), te) for s in distinct])
    return scored.groupBy(ALERT_ID).agg(F.avg("score").alias("score"))
