"""Shared model inputs: the feature frame (written once), labels, imputation,
and deterministic stand-in "models" used to exercise the ranking, blending and
checking operators with SQL-checkable scores.

The stand-in models are feature columns used directly as scores; the
out-of-fold "prediction" of a stand-in in a (repeat, fold) is its rank
percentile inside that validation fold -- the same per-fold scale a fitted
model's OOF vector has.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators.folds import stratified_folds
from ..operators.impute import apply_medians, fit_medians
from ..operators.rank import rank_percentile
from ..schema import ALERT_ID, LABEL, SPLIT
from ..session import written_once

# --- fixed values: stand-in models (feature columns used as scores) --------
STANDIN_MODELS = ("base_mean", "dir_sh_out", "win_rate30", "amt_q90")
GRID_MODELS = STANDIN_MODELS[:3]
N_REPEATS = 4
N_PERMUTATIONS = 5
TOP_K = 10
TRACE_ROUNDS = 3
# ---------------------------------------------------------------------------


# Feature tables written in this session: (application, input, input mtimes)
# -> (frame stored by column, train medians).  Like a feature store: the history
# shuffle is paid once per input, every model stage reads the written table.
_WRITTEN: dict[tuple, dict] = {}


def _input_key(inputs) -> tuple:
    spark = inputs.spark
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    stamps = []
    for name in ("events", "customer"):
        path = jvm.org.apache.hadoop.fs.Path(f"{inputs.sf_dir.rstrip('/')}/{name}.parquet")
        st = path.getFileSystem(conf).getFileStatus(path)
        stamps.append((name, st.getModificationTime(), st.getLen()))
    return (spark.sparkContext.applicationId, inputs.sf_dir.rstrip("/"), tuple(stamps))


def _written(inputs) -> dict:
    key = _input_key(inputs)
    if key not in _WRITTEN:
        f = feat.build_features(inputs.history, inputs.alerts, reference=inputs.train)
        _WRITTEN[key] = {"features": written_once(f.join(inputs.alerts.select(ALERT_ID, LABEL, SPLIT), ALERT_ID))}
    return _WRITTEN[key]


def memo(inputs, name: str, compute):
    """Driver-side result of one input (small metadata such as a selection
    trace), computed once per session and input like the feature table."""
    w = _written(inputs)
    if name not in w:
        w[name] = compute()
    return w[name]


def feature_frame(inputs) -> DataFrame:
    """All alerts' 128 features (test anchored to train), written once to the
    checkpoint folder; every model loop starts from the written table."""
    return _written(inputs)["features"]


def imputed(inputs, columns: Sequence[str] | None = None) -> DataFrame:
    """Features imputed with medians fitted on the train split: all of them, or
    ``columns`` alone beside id, label and split.  The medians of a column are
    fitted once per input, when the column is first asked for."""
    w = _written(inputs)
    medians = w.setdefault("medians", {})
    columns = list(feat.feature_columns() if columns is None else columns)
    missing = [c for c in columns if c not in medians]
    if missing:
        medians.update(fit_medians(w["features"].where(F.col(SPLIT) == "train"), missing))
    return apply_medians(w["features"].select(ALERT_ID, *columns, LABEL, SPLIT), {c: medians[c] for c in columns})


def train_frame(inputs, columns: Sequence[str] | None = None) -> DataFrame:
    return imputed(inputs, columns).where(F.col(SPLIT) == "train")


def test_frame(inputs, columns: Sequence[str] | None = None) -> DataFrame:
    return imputed(inputs, columns).where(F.col(SPLIT) == "test")


def standin_long(frame: DataFrame, models=STANDIN_MODELS) -> DataFrame:
    """``(alert_id, label, model, score)`` of the stand-in models."""
    return frame.select(ALERT_ID, LABEL, *models).unpivot([ALERT_ID, LABEL], list(models), "model", "score")


def standin_oof(frame: DataFrame, models=STANDIN_MODELS, n_repeats: int = N_REPEATS) -> DataFrame:
    """``(alert_id, label, repeat, fold, model, score)``: per-fold rank percentile."""
    folds = stratified_folds(frame, n_repeats=n_repeats)
    long = standin_long(frame, models).join(folds, ALERT_ID)
    pct = rank_percentile(long, ["model", "repeat", "fold"], "score", "oof")
    return pct.select(ALERT_ID, LABEL, "repeat", "fold", "model", F.col("oof").alias("score"))


def standin_pct_wide(frame: DataFrame, models=GRID_MODELS) -> DataFrame:
    """``(alert_id, label, <model>...)`` rank percentiles over all rows."""
    pct = rank_percentile(standin_long(frame, models), ["model"], "score", "pct")
    return pct.groupBy(ALERT_ID, LABEL).pivot("model", list(models)).agg(F.first("pct"))
