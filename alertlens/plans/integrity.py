"""Is the reported score real?  Label-permutation null and holdout estimate."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values of the verdict -------------------------------------------
LEAK_EXCESS = 0.10     # null mean more than this above 0.5 -> leaking
SE_MULTIPLE = 2.0      # |null mean - 0.5| within 2 standard errors -> clean
# ---------------------------------------------------------------------------
PARALLEL_DRAWS = 6     # observed + label shuffles submitted concurrently


def judge_null(null_scores: DataFrame, n_rows: Column | int, score_col: str = "score") -> DataFrame:
    """Classify a null distribution by its MEAN: clean / leaking / optimistic.

    ``se = sqrt(1 / max(n_rows, 2))``; within 2 se of 0.5 is clean, more than
    0.10 above is leaking, anything else (also well below 0.5) optimistic."""
    n = n_rows if isinstance(n_rows, Column) else F.lit(int(n_rows))
    agg = null_scores.agg(F.avg(score_col).alias("null_mean"), F.count(score_col).alias("n_scores"))
    se = F.sqrt(F.lit(1.0) / F.greatest(n.cast("double"), F.lit(2.0)))
    excess = F.col("null_mean") - F.lit(0.5)
    return agg.select(
        F.when(F.abs(excess) <= F.lit(SE_MULTIPLE) * se, F.lit("clean"))
         .when(excess > F.lit(LEAK_EXCESS), F.lit("leaking"))
         .otherwise(F.lit("optimistic")).alias("verdict"),
        F.col("null_mean"), (F.lit(SE_MULTIPLE) * se).alias("two_se"),
        n.cast("long").alias("n_rows"), F.col("n_scores"))


def _select_and_score(frame, columns, model, sizes, label="label", ranked=None):
    from .cv import evaluate_many
    from .models import make_factory
    from .select import rank_columns
    if ranked is None:
        ranked = [r["column"] for r in rank_columns(frame, columns, model, n_repeats=3, label=label).collect()]
    cands = {str(s): ranked[:s] for s in sizes if s <= len(ranked)}
    if not cands:
        cands = {"all": ranked}
    res = evaluate_many(make_factory(model), frame, cands, n_repeats=2, label=label)
    best = max(res.values(), key=lambda r: r.mean)
    return best.mean


def permutation_test(frame: DataFrame, columns, model: str = "logreg", n_permutations: int = 5,
                     sizes=(10, 20, 30), simulate_leak: bool = False, label: str = "label"):
    """Observed select-and-score, and the same under ``n_permutations`` label
    shuffles (position join on md5 ranks; seed 42+p).  ``simulate_leak`` adds
    a column equal to the labels in use, so the check can be shown to fire.

    Shuffled are ids and labels alone.  For a logistic regression the rows are joined
    with the labels of all draws once, and the columns of all draws are ranked together."""
    from ..operators.rank import permute
    from ..schema import ALERT_ID
    from ..session import written_once
    from .select import rank_draws
    columns = list(columns)
    cols = columns + (["_leak"] if simulate_leak else [])

    def with_leak(df):
        return df.withColumn("_leak", F.col(label).cast("double")) if simulate_leak else df

    def shuffled(p):
        """p = -1 is the observed labels, p >= 0 the shuffle with seed 42+p."""
        if p < 0:
            return None
        return permute(frame.select(ALERT_ID, label), ALERT_ID, label, 42 + p).checkpoint()

    def relabelled(labels, names):
        """The rows with the labels of a draw, written once; rows of one id get its labels in any order."""
        if labels is None:
            return frame
        of = labels.groupBy(ALERT_ID).agg(F.sort_array(F.collect_list(label)).alias("_of"))
        place = F.row_number().over(Window.partitionBy(ALERT_ID).orderBy(ALERT_ID))
        return written_once(frame.select(ALERT_ID, *names).join(of, ALERT_ID).withColumn("_place", place)
                            .select(ALERT_ID, F.element_at("_of", F.col("_place")).alias(label), *names))

    def score(p):
        if p not in rankings:
            return _select_and_score(with_leak(relabelled(draws[p], columns)), cols, model, sizes, label)
        ranked = [r["column"] for r in rankings[p].collect()]
        used = ranked[:max((s for s in sizes if s <= len(ranked)), default=len(ranked))]
        return _select_and_score(relabelled(draws[p], used), cols, model, sizes, label, ranked)

    # the draws are independent Spark job chains: submit them together from
    # a driver thread pool so the scheduler overlaps their (often small)
    # stages; each result is keyed by its draw, so the order is fixed
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(PARALLEL_DRAWS, n_permutations + 1)) as pool:
        draws = dict(zip(range(-1, n_permutations), pool.map(shuffled, range(-1, n_permutations))))
        rankings = rank_draws(frame, cols, draws, 3, label=label) if model == "logreg" and not simulate_leak else {}
        scores = list(pool.map(score, draws))
    return scores[0], scores[1:]


def holdout_estimate(frame: DataFrame, columns, model: str = "logreg",
                     sizes=(10, 15, 20, 25, 30, 40), fraction: float = 0.2,
                     tune_trials: int = 0, label: str = "label") -> dict:
    """Select (and optionally tune) on 80 %, score the untouched 20 % once."""
    from ..operators.folds import holdout_split
    from ..operators.impute import apply_medians, fit_medians
    from ..operators.rank import grouped_auc
    from ..schema import ALERT_ID
    from .cv import evaluate_many
    from .models import assemble, fit, make_factory, predict
    from .select import rank_columns
    split = holdout_split(frame, fraction=fraction, label=label).select(ALERT_ID, "is_holdout")
    keyed = frame.join(split, ALERT_ID).checkpoint()
    train, hold = keyed.where(~F.col("is_holdout")), keyed.where(F.col("is_holdout"))
    ranked = [r["column"] for r in rank_columns(train, columns, model, label=label).collect()]
    cands = {str(s): ranked[:s] for s in sizes if s <= len(ranked)} or {"all": ranked}
    res = evaluate_many(make_factory(model), train, cands, label=label)
    best_key = max(cands, key=lambda k: (res[k].mean, -len(cands[k])))
    chosen = cands[best_key]
    params = None
    if tune_trials:
        from .tune import tune
        params, _ = tune(model, train, chosen, n_trials=tune_trials)
    medians = fit_medians(train, chosen)
    tr = assemble(apply_medians(train, medians), chosen, keep=(ALERT_ID, label))
    ho = assemble(apply_medians(hold, medians), chosen, keep=(ALERT_ID, label))
    est = fit(make_factory(model, params), tr, 42, tr.count())
    auc = grouped_auc(predict(est, ho, keep=(ALERT_ID, label)), [], "score", label).first()["auc"]
    return {"cv_mean": res[best_key].mean, "cv_std": res[best_key].std, "holdout_auc": float(auc),
            "optimism": res[best_key].mean - float(auc), "n_train": train.count(),
            "n_holdout": hold.count(), "columns": chosen, "params": params}
