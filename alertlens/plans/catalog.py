"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through ``sources.driver_tables`` and
runs on the whole tables.  Outputs are normalised for the oracle comparison:
integral columns as BIGINT, fractional columns as DOUBLE rounded to 6
decimals (sums differ in the last bits with the addition order).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import blend, check, eda, folds, impute, rank
from ..operators import features as feat
from ..operators import prepare as prep
from ..schema import ALERT_ID, FAMILIES, LABEL, SPLIT
from ..session import split_hot_alerts, written_once
from . import ablation, integrity
from . import scoring as sc
from ..sources import driver_tables as dt

ROUND = 6
# Values are rounded after a 1e-9 nudge: averages of data with few decimals
# often sit exactly on a rounding tie, where engines round differently.
NUDGE = 1e-9
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def normalise(df: DataFrame, digits: int = ROUND) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _INTEGRAL):
            cols.append(c.cast("long").alias(f.name))
        elif isinstance(f.dataType, _FRACTIONAL):
            cols.append(F.round(c.cast("double") + F.lit(NUDGE), digits).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


class Inputs:
    """Lazily built, shared inputs of one (spark, sf_dir) pair."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        split_hot_alerts(spark)
        self.tx = dt.transactions(spark, sf_dir)
        self.alerts = dt.alerts(spark, sf_dir)
        self.train = dt.split(self.alerts, "train")
        self.test = dt.split(self.alerts, "test")
        self.history = prep.prepare(self.tx, self.alerts)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ----------------------------------------------------------- readers

@register("read_alerts")
def read_alerts(spark, sf_dir):
    """Orders read as an alert file."""
    from ..sources.readers import read_alerts as read
    return normalise(read(spark, f"{sf_dir.rstrip('/')}/orders.parquet",
                          {ALERT_ID: "o_orderkey", "alert_date": "o_orderdate"}, fmt="parquet"))


@register("read_transactions")
def read_transactions(spark, sf_dir):
    """Events read as a transaction file."""
    from ..sources.readers import read_transactions as read
    return normalise(read(spark, f"{sf_dir.rstrip('/')}/events.parquet",
                          {ALERT_ID: "user_id", "tx_ts": "ts", "direction": "event_type", "tx_type": "event_type",
                           "amount": "value"}))


# ----------------------------------------------------------- step 1: prepare

@register("prepare_history")
def prepare_history(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return normalise(i.history.select("alert_id", "tx_ts", "direction", "tx_type", "amount",
                                      "days_before", "out", "hour", "dow"))


@register("prep_audit")
def prep_audit(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return normalise(prep.prep_audit(i.tx, i.alerts))


@register("silent_alerts")
def silent_alerts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return normalise(prep.silent_alerts(i.alerts, i.history).select("alert_id", "split"))


@register("dedup_alerts")
def dedup_alerts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    # every train alert listed twice, the second row with another date and label
    other = i.train.withColumn("alert_date", F.timestamp_add("DAY", F.when(F.col("alert_id") % 2 == 0, 1).otherwise(-1),
                                                             F.col("alert_date"))).withColumn(LABEL, 1 - F.col(LABEL))
    return normalise(prep.dedup_alerts(i.alerts.unionByName(other)))


# ----------------------------------------------------- steps 2-3: features

def _features(families):
    def run(spark, sf_dir):
        i = Inputs(spark, sf_dir)
        return normalise(feat.build_features(i.history, i.alerts, families=families,
                                             reference=i.train))
    return run


for _family in FAMILIES:
    QUERIES[f"feat_{_family}"] = _features([_family])
QUERIES["feat_all"] = _features(None)


# ------------------------------------------------------------- step 4: EDA

def _train_inputs(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    i.train_history = prep.prepare(i.tx, i.train, carry=(LABEL,))
    return i


def _eda(fn, needs_history=True):
    def run(spark, sf_dir):
        i = _train_inputs(spark, sf_dir)
        return normalise(fn(i.train, i.train_history) if needs_history else fn(i.train))
    return run


QUERIES["eda_target"] = _eda(eda.target, needs_history=False)
QUERIES["eda_weekly_volume"] = lambda spark, sf_dir: normalise(
    eda.weekly_volume(_train_inputs(spark, sf_dir).train_history))
QUERIES["eda_direction"] = lambda spark, sf_dir: normalise(
    eda.direction_counts(_train_inputs(spark, sf_dir).train_history))
QUERIES["eda_types"] = lambda spark, sf_dir: normalise(
    eda.type_counts(_train_inputs(spark, sf_dir).train_history))
QUERIES["eda_amount_by_outcome"] = _eda(eda.amount_by_outcome)
QUERIES["eda_volume_by_outcome"] = _eda(eda.volume_by_outcome)
QUERIES["eda_days_before_hist"] = _eda(eda.days_before_hist)
QUERIES["eda_type_by_outcome"] = _eda(eda.type_by_outcome)
QUERIES["eda_days_before_share"] = _eda(eda.days_before_share)
QUERIES["eda_type_mix_share"] = _eda(eda.type_mix_share)
QUERIES["eda_headline"] = _eda(eda.headline)
QUERIES["history_profile"] = lambda spark, sf_dir: normalise(
    eda.history_profile(_train_inputs(spark, sf_dir).train_history))


def _history_sketch(spark, sf_dir):
    """Daily sketches written as a table, read back and merged (E5, E13 approximate)."""
    h = _train_inputs(spark, sf_dir).train_history
    return normalise(eda.sketch_check(h, written_once(eda.daily_sketches(h))))


QUERIES["history_sketch"] = _history_sketch


# ------------------------------------- steps 5-6: ranks, folds, blends, checks

def _q(fn):
    def run(spark, sf_dir):
        return normalise(fn(Inputs(spark, sf_dir)))
    return run


def _stratified_folds(i):
    return folds.stratified_folds(sc.train_frame(i, ()), n_repeats=sc.N_REPEATS)


def _holdout_split(i):
    return folds.holdout_split(sc.train_frame(i, ()), fraction=0.2)


def _median_impute(i):
    return sc.imputed(i).select(ALERT_ID, *feat.feature_columns())


def _auc_by_column(i):
    long = impute.long_format(sc.train_frame(i), feat.feature_columns(), [ALERT_ID, LABEL])
    return rank.grouped_auc(long, ["column"], "value", LABEL)


def _rank_percentile(i):
    pct = rank.rank_percentile(sc.standin_long(sc.train_frame(i, sc.STANDIN_MODELS)), ["model"], "score", "pct")
    return pct.select(ALERT_ID, "model", "pct")


def _union_split(i):
    f = sc.feature_frame(i)
    train = f.where(F.col(SPLIT) == "train").select(ALERT_ID, *feat.feature_columns())
    test = f.where(F.col(SPLIT) == "test").select(ALERT_ID, *feat.feature_columns())
    common = [c for c in train.columns if c in test.columns]
    return (train.select(*common).withColumn("is_test", F.lit(0))
            .unionByName(test.select(*common).withColumn("is_test", F.lit(1))))


def _null_verdict(i):
    frame = sc.train_frame(i, sc.STANDIN_MODELS[:1]).select(ALERT_ID, LABEL, F.col(sc.STANDIN_MODELS[0]).alias("score"))
    seeds = frame.withColumn("seed", F.explode(F.array(*[F.lit(folds.SEED + p)
                                                         for p in range(sc.N_PERMUTATIONS)])))
    shuffled = rank.permute(seeds, ALERT_ID, LABEL, "seed", keys=["seed"])
    aucs = rank.grouped_auc(shuffled, ["seed"], "score", LABEL).select(F.col("auc").alias("score"))
    n_rows = frame.agg(F.count(F.lit(1))).scalar()
    return integrity.judge_null(aucs, n_rows)


def _repeat_aucs(i):
    oof = sc.standin_oof(sc.train_frame(i, sc.STANDIN_MODELS))
    return rank.grouped_auc(oof, ["model", "repeat"], "score", LABEL)


def _cv_summary(i):
    per = _repeat_aucs(i)
    return per.groupBy("model").agg(
        F.avg("auc").alias("cv_mean"), F.stddev_pop("auc").alias("cv_std")).withColumn(
        "score", F.col("cv_mean") - F.col("cv_std"))


def _rank_average(i):
    return blend.rank_average(sc.standin_long(sc.train_frame(i, sc.STANDIN_MODELS)), sc.STANDIN_MODELS)


def _blend_by_repeat(i):
    train = sc.train_frame(i, sc.STANDIN_MODELS)
    oof = sc.standin_oof(train)
    per = blend.score_blend(oof, train, sc.STANDIN_MODELS)
    return (per.withColumn("blend_mean", per.agg(F.avg("auc")).scalar())
            .withColumn("blend_std", per.agg(F.stddev_pop("auc")).scalar()))


def _weight_grid(i):
    return blend.weight_grid(sc.standin_pct_wide(sc.train_frame(i, sc.GRID_MODELS)), sc.GRID_MODELS)


def _weight_choice(i):
    return blend.choose_weights(sc.standin_pct_wide(sc.train_frame(i, sc.GRID_MODELS)), sc.GRID_MODELS)


def _test_scores(i):
    return blend.rank_average(sc.standin_long(sc.test_frame(i, sc.STANDIN_MODELS)), sc.STANDIN_MODELS)


def _result_check(i):
    return check.check_result(_test_scores(i).select(ALERT_ID, "score"), i.test.select(ALERT_ID))


def _result_ordered(i):
    expected = check.expected_with_ordinal(
        i.test.select(ALERT_ID, F.md5(F.col(ALERT_ID).cast("string")).alias("_order")), "_order")
    return check.ordered_result(_test_scores(i), expected)


def _top_columns(i):
    aucs = _auc_by_column(i)
    return rank.row_number(aucs.select("column", "auc").withColumn(
        "_key", F.struct(-F.round("auc", blend.AUC_TIE_DIGITS), F.col("column"))),
        [], "_key", "rank").where(F.col("rank") <= sc.TOP_K).drop("_key")


for _name, _fn in {
    "stratified_folds": _stratified_folds, "holdout_split": _holdout_split,
    "median_impute": _median_impute, "roc_auc_by_column": _auc_by_column,
    "rank_percentile": _rank_percentile, "union_split": _union_split,
    "null_verdict": _null_verdict, "cv_summary": _cv_summary,
    "rank_average": _rank_average, "blend_by_repeat": _blend_by_repeat,
    "weight_grid": _weight_grid, "weight_choice": _weight_choice,
    "result_check": _result_check, "result_ordered": _result_ordered,
    "top_columns": _top_columns,
}.items():
    QUERIES[_name] = _q(_fn)


# ------------------------------ steps 7-8: model-based queries (rows checked)

def _train_raw(i):
    return sc.feature_frame(i).where(F.col(SPLIT) == "train")


def _test_raw(i):
    return sc.feature_frame(i).where(F.col(SPLIT) == "test")


REFERENCE_FAMILY_SET = feat.family_columns("direction_type") + feat.family_columns("base")


def _repeated_cv(i):
    from .cv import evaluate
    from .models import make_factory
    res = evaluate(make_factory("logreg"), _train_raw(i), REFERENCE_FAMILY_SET)
    rows = [(r, a, res.mean, res.std, res.score) for r, a in enumerate(res.repeat_scores)]
    return i.spark.createDataFrame(rows, "repeat int, auc double, cv_mean double, cv_std double, score double")


def _family_history(i):
    from .select import select_families
    # one greedy search per input: select_families, ablation_rounds and
    # ablation_verdict all read the same trace (a few dozen metadata rows)
    _, history = sc.memo(i, "family_trace", lambda: select_families(
        _train_raw(i), {f: feat.family_columns(f) for f in FAMILIES}))
    return i.spark.createDataFrame(
        [(h["round"], h["family"], h["n_columns"], h["mean"], h["std"], h["score"], h["accepted"]) for h in history],
        "round int, family string, n_columns int, mean double, std double, score double, accepted boolean")


def _ablation_rounds(i):
    """Per-family round number (W2) and what became of each offer."""
    h = _family_history(i)
    return ablation.numbered(h).withColumn("verdict", F.when(F.col("accepted"), F.lit("kept")).otherwise(F.lit("rejected")))


def _ablation_verdict(i):
    return ablation.verdict(_family_history(i))


def _standin_trace(i):
    """A trace without a model: in round r a family scores the ROC-AUC of its r-th column, the best one is accepted."""
    columns = {(r, f): feat.family_columns(f)[r - 1] for r in range(1, sc.TRACE_ROUNDS + 1) for f in FAMILIES}
    long = impute.long_format(sc.train_frame(i, list(columns.values())), list(columns.values()), [ALERT_ID, LABEL])
    aucs = rank.grouped_auc(long, ["column"], "value", LABEL)
    offers = i.spark.createDataFrame([(r, f, r, c) for (r, f), c in columns.items()], "round int, family string, n_columns int, column string")
    from pyspark.sql import Window
    best = Window.partitionBy("round").orderBy(F.desc("score"), "family")
    return (offers.join(aucs, "column").withColumn("score", F.round("auc", 9))
            .select("round", "family", "n_columns", F.col("score").alias("mean"), F.lit(0.0).alias("std"), "score",
                    (F.row_number().over(best) == 1).alias("accepted")))


def _expected_ids(i):
    """Requested ids read back from the files of a sample, with their place in them."""
    from ..sources.readers import read_expected_ids
    out = _out_dir(i, "ids")
    i.test.select(F.col(ALERT_ID).cast("string").alias(ALERT_ID), F.md5(F.col(ALERT_ID).cast("string")).alias("_o")).repartitionByRange(
        "_o").sortWithinPartitions("_o").select(ALERT_ID).write.option("header", True).csv(out)
    return read_expected_ids(i.spark, out, id_column=ALERT_ID)


def _rank_columns(i):
    from .select import rank_columns
    return rank_columns(_train_raw(i), feat.feature_columns())


def _eliminate_columns(i):
    from .select import eliminate_columns
    kept = eliminate_columns(_train_raw(i), feat.feature_columns())
    return i.spark.createDataFrame([(c,) for c in kept], "column string")


def _select_prefix(i):
    from .select import select_columns_globally
    cols, trace = select_columns_globally(_train_raw(i), feat.feature_columns())
    return i.spark.createDataFrame(
        [(t["size"], t["mean"], t["std"], t["score"], t["size"] == len(cols)) for t in trace],
        "size int, mean double, std double, score double, chosen boolean")


def _drift_report(i):
    from .drift import drift_report
    auc, ranked = drift_report(_train_raw(i), _test_raw(i), feat.feature_columns())
    return ranked.withColumn("auc", F.lit(auc))


def _bagged_scores(i):
    from .models import SEEDS, bagged_predict, default_params
    # a model that uses its seed; few rounds, as the query shows the bagging
    return bagged_predict("gbt", {**default_params("gbt"), "maxIter": 10, "maxDepth": 2}, _train_raw(i), _test_raw(i),
                          REFERENCE_FAMILY_SET, SEEDS[:3])


def _tune_trials(i):
    from .tune import tune
    _, table = tune("logreg", _train_raw(i), REFERENCE_FAMILY_SET, n_trials=40)
    return table


def _holdout_estimate(i):
    from .integrity import holdout_estimate
    r = holdout_estimate(_train_raw(i), feat.feature_columns())
    return i.spark.createDataFrame(
        [(r["cv_mean"], r["cv_std"], r["holdout_auc"], r["optimism"], r["n_train"], r["n_holdout"],
          len(r["columns"]))],
        "cv_mean double, cv_std double, holdout_auc double, optimism double, n_train long, "
        "n_holdout long, n_columns int")


def _permutation_null(i):
    from .integrity import judge_null, permutation_test
    train = _train_raw(i)
    observed, nulls = permutation_test(train, feat.feature_columns())
    scores = i.spark.createDataFrame([(float(s),) for s in nulls], "score double")
    verdict = judge_null(scores, train.count()).first()
    rows = [("observed", 0, float(observed), verdict["verdict"])] + \
        [("null", k + 1, float(s), verdict["verdict"]) for k, s in enumerate(nulls)]
    return i.spark.createDataFrame(rows, "kind string, draw int, score double, verdict string")


def _file_audit(i):
    from ..sources.audit import audit_parquet
    return audit_parquet(i.spark, i.sf_dir).select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "length", "head_magic", "tail_magic",
        "readable", "replacement_chars")


def _publish_guard(i):
    th = prep.prepare(i.tx, i.train)
    tables = {"target": eda.target(i.train), "weekly_volume": eda.weekly_volume(th),
              "direction": eda.direction_counts(th), "types": eda.type_counts(th),
              "amount_by_outcome": eda.amount_by_outcome(i.train, th),
              "volume_by_outcome": eda.volume_by_outcome(i.train, th),
              "days_before_hist": eda.days_before_hist(i.train, th),
              "type_by_outcome": eda.type_by_outcome(i.train, th)}
    return eda.publish_guard(tables, i.alerts.select(ALERT_ID))


def _out_dir(i, name):
    from ..session import ensure_checkpoint_dir
    from uuid import uuid4
    return f"{ensure_checkpoint_dir(i.spark).rstrip('/')}/alertlens-{name}-{uuid4().hex}"


def _run_log(i):
    from ..sources.sinks import log_run, read_log
    from .cv import evaluate
    from .models import make_factory
    res = evaluate(make_factory("logreg"), _train_raw(i), REFERENCE_FAMILY_SET)
    out = _out_dir(i, "log")
    log_run(i.spark, out, mean=res.mean, std=res.std, families=["direction_type", "base"],
            n_columns=len(REFERENCE_FAMILY_SET), model="logreg", params={"C": 0.1})
    return read_log(i.spark, out)


def _score_and_write(i):
    from .run import predict_and_write
    out = _out_dir(i, "result")
    drift = predict_and_write(i.spark, _train_raw(i), _test_raw(i), i.test.select(ALERT_ID),
                              REFERENCE_FAMILY_SET, {"logreg": 1.0}, {"logreg": None}, out)
    kind = dict(i.test.dtypes)[ALERT_ID]
    written = check.read_result(i.spark, f"{out}/result", f"{ALERT_ID} {kind}, score double")
    return written.withColumn("adversarial_auc", F.lit(drift["adversarial_auc"]))


for _name, _fn in {
    "repeated_cv": _repeated_cv, "select_families": _family_history,
    "ablation_rounds": _ablation_rounds, "ablation_verdict": _ablation_verdict,
    "rank_columns": _rank_columns, "eliminate_columns": _eliminate_columns,
    "select_prefix": _select_prefix, "drift_report": _drift_report,
    "bagged_scores": _bagged_scores, "tune_trials": _tune_trials,
    "holdout_estimate": _holdout_estimate, "permutation_null": _permutation_null,
    "file_audit": _file_audit, "publish_guard": _publish_guard,
    "run_log": _run_log, "score_and_write": _score_and_write, "expected_ids": _expected_ids,
    "trace_rounds": lambda i: ablation.numbered(_standin_trace(i)),
    "trace_first_round": lambda i: ablation.first_round(_standin_trace(i)),
    "trace_ablation": lambda i: ablation.ablation(_standin_trace(i)),
    "trace_verdict": lambda i: ablation.verdict(_standin_trace(i)),
}.items():
    QUERIES[_name] = _q(_fn)
