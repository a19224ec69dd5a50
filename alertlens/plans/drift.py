"""Adversarial validation: can a classifier tell train from test?."""
from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.folds import N_SPLITS, SEED, stratified_folds
from ..operators.impute import apply_medians, fit_medians
from ..operators.rank import grouped_auc
from ..schema import ALERT_ID
from .models import assemble, default_params, feature_importances, fit, make_factory, predict

DRIFT_WARNING_AUC = 0.75
#: the separability test needs a coarse classifier only
DRIFT_ROUNDS = {"gbt": {"maxIter": 60, "stepSize": 0.1}, "gbt_shallow": {"maxIter": 60, "stepSize": 0.1}, "rf": {"numTrees": 100}}


def union_splits(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Common columns (order of ``columns``) of both frames with an ``is_test`` flag."""
    common = [c for c in columns if c in train.columns and c in test.columns]
    both = (train.select(ALERT_ID, *common).withColumn("is_test", F.lit(0))
            .unionByName(test.select(ALERT_ID, *common).withColumn("is_test", F.lit(1))))
    return both, common


def drift_report(train: DataFrame, test: DataFrame, columns: Sequence[str],
                 model: str = "gbt") -> tuple[float, DataFrame]:
    """OOF AUC of train-vs-test and per-column importance summed over 5 folds."""
    both, common = union_splits(train, test, columns)
    # distinct ids per split: an id in both splits keeps one row per split
    both = both.withColumn(ALERT_ID, F.concat(F.col("is_test").cast("string"), F.lit(":"),
                                               F.col(ALERT_ID).cast("string")))
    medians = fit_medians(both, common)                      # train + test combined
    imputed = apply_medians(both, medians)
    folds = stratified_folds(imputed, n_repeats=1, label="is_test")
    keyed = imputed.join(folds, ALERT_ID).checkpoint()
    factory = make_factory(model, {**default_params(model), **DRIFT_ROUNDS.get(model, {})})

    def run(k):
        tr = assemble(keyed.where(F.col("fold") != k), common, keep=(ALERT_ID, "is_test"))
        va = assemble(keyed.where(F.col("fold") == k), common, keep=(ALERT_ID, "is_test"))
        est = fit(factory, tr.withColumnRenamed("is_test", "label"), SEED, tr.count())
        return predict(est, va, keep=(ALERT_ID, "is_test")), feature_importances(est, common)

    with ThreadPoolExecutor(max_workers=N_SPLITS) as pool:
        results = list(pool.map(run, range(N_SPLITS)))
    oof = results[0][0]
    for p, _ in results[1:]:
        oof = oof.unionByName(p)
    auc = grouped_auc(oof, [], "score", "is_test").first()["auc"]
    totals: dict[str, float] = {}
    for _, imps in results:
        for c, v in imps:
            totals[c] = totals.get(c, 0.0) + v
    spark = train.sparkSession
    ranked = spark.createDataFrame([(c, totals.get(c, 0.0)) for c in common],
                                   "column string, importance double").orderBy(F.desc("importance"), "column")
    return float(auc) if auc is not None else float("nan"), ranked
