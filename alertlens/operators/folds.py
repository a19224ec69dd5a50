"""Stratified repeated k-fold and stratified holdout split (M1, M2).

Folds are a pure function of (alert id, seed): the rank of
``md5(id || ':' || seed)`` within the label, modulo k.  No ``rand()``, so the
assignment does not depend on partitioning, and the rank comes from the
distributed ``row_number`` (a label class can hold most of the rows).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ALERT_ID, LABEL
from .rank import row_number

SEED = 42
N_SPLITS = 5


def seeded_hash(id_col: str, seed) -> F.Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(":"), F.lit(str(seed))))


def stratified_folds(df: DataFrame, n_repeats: int = 4, n_splits: int = N_SPLITS,
                     seed: int = SEED, id_col: str = ALERT_ID, label: str = LABEL) -> DataFrame:
    """``(id, repeat, fold)`` for every row and repeat; seed of repeat r is seed+r."""
    reps = df.select(id_col, label).withColumn(
        "repeat", F.explode(F.array(*[F.lit(r) for r in range(n_repeats)])))
    hashed = reps.withColumn("_h", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(":"),
                                                  (F.lit(seed) + F.col("repeat")).cast("string"))))
    ranked = row_number(hashed, ["repeat", label], "_h", "_rn")
    return ranked.select(id_col, "repeat", ((F.col("_rn") - 1) % n_splits).cast("int").alias("fold"))


def holdout_split(df: DataFrame, fraction: float = 0.2, seed: int = SEED,
                  id_col: str = ALERT_ID, label: str = LABEL) -> DataFrame:
    """``(id, label, is_holdout)``: the first ``ceil(fraction * n_label)`` rows of
    each label class in seeded-hash order are held out."""
    hashed = df.select(id_col, label).withColumn("_h", seeded_hash(id_col, seed))
    ranked = row_number(hashed, [label], "_h", "_rn")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return (ranked.join(sizes, label)
            .select(id_col, label, (F.col("_rn") <= F.ceil(F.lit(fraction) * F.col("_n"))).alias("is_holdout")))


def fold_frames(folds: DataFrame, repeat: int, fold: int, id_col: str = ALERT_ID) -> tuple[DataFrame, DataFrame]:
    """Ids of the training part and the validation part of one (repeat, fold)."""
    f = folds.where(F.col("repeat") == repeat)
    return (f.where(F.col("fold") != fold).select(id_col), f.where(F.col("fold") == fold).select(id_col))


def split_ids(folds: DataFrame, repeats: Sequence[int]) -> list[tuple[int, int]]:
    return [(r, k) for r in repeats for k in range(N_SPLITS)]
