"""Global ranks, ROC-AUC and permutations without single-task windows.

All of them reduce to prefix sums along a sort order within a group, which
``ordered_scan`` computes with range partitioning.  Ties are first
collapsed map-side into (group, value) counts, so the ranked table has one row
per distinct score and tie semantics (average rank, half credit in AUC) are
exact.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import ordered_scan

ALL = "_all"


def _with_group(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    keys = list(keys)
    if keys:
        return df, keys
    return df.withColumn(ALL, F.lit(0)), [ALL]


def row_number(df: DataFrame, keys: Sequence[str], order: str, name: str = "rn") -> DataFrame:
    """1-based position within ``keys`` along a unique ``order`` column."""
    data, k = _with_group(df, keys)
    scanned = ordered_scan(data.withColumn("_one", F.lit(1.0)), k, order, weights=["_one"])
    out = scanned.withColumn(name, (F.col("_before__one") + 1).cast("long"))
    return out.drop("_one", "_before__one", *([ALL] if not keys else []))


def rank_percentile(df: DataFrame, keys: Sequence[str], score: str,
                    name: str = "pct") -> DataFrame:
    """Average-tie rank percentile ``(rank-1)/max(n-1,1)`` over all rows of a group."""
    data, k = _with_group(df, keys)
    counted = (data.where(F.col(score).isNotNull()).groupBy(*k, score)
               .agg(F.count(F.lit(1)).cast("double").alias("_c")))
    ranked = ordered_scan(counted, k, score, weights=["_c"], with_totals=True)
    avg_rank = F.col("_before__c") + (F.col("_c") + 1) / 2
    pct = ranked.select(
        *k, score, ((avg_rank - 1) / F.greatest(F.col("_total__c") - 1, F.lit(1.0))).alias(name))
    out = data.join(pct, [*k, score], "left")
    return out.drop(ALL) if not keys else out


def grouped_auc(df: DataFrame, keys: Sequence[str], score: str, label: str,
                name: str = "auc") -> DataFrame:
    """ROC-AUC of ``score`` against a 0/1 ``label`` per group (ties count half).

    ``sum over positives of (negatives below + negatives tied / 2) / (P * N)``;
    NULL when a group has only one class.
    """
    data, k = _with_group(df, keys)
    counted = (data.where(F.col(score).isNotNull() & F.col(label).isNotNull())
               .groupBy(*k, score)
               .agg(F.sum(F.col(label).cast("double")).alias("_pos"),
                    F.sum(1 - F.col(label).cast("double")).alias("_neg")))
    ranked = ordered_scan(counted, k, score, weights=["_neg"])
    out = ranked.groupBy(*k).agg(
        F.sum(F.col("_pos") * (F.col("_before__neg") + F.col("_neg") / 2)).alias("_num"),
        F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))
    out = out.select(*k, F.try_divide(F.col("_num"), F.col("n_pos") * F.col("n_neg")).alias(name),
                     F.col("n_pos").cast("long").alias("n_pos"),
                     F.col("n_neg").cast("long").alias("n_neg"))
    return out.drop(ALL) if not keys else out


def permute(df: DataFrame, id_col: str, value_col: str, seed,
            keys: Sequence[str] = ()) -> DataFrame:
    """Deterministic shuffle of ``value_col`` across rows (within ``keys``).

    Position join: the row at rank p under ``md5(id)`` receives the value of
    the row at rank p under ``md5(id || ':' || seed)``.  ``seed`` is a literal
    or the name of a column (one shuffle per seed value when it is a key).
    Independent of partitioning; both rankings are distributed."""
    keys = list(keys)
    seed_expr = F.col(seed) if isinstance(seed, str) and seed in df.columns else F.lit(str(seed))
    base = df.withColumn("_h0", F.md5(F.col(id_col).cast("string")))
    base = base.withColumn("_h1", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(":"),
                                                 seed_expr.cast("string"))))
    left = row_number(base.drop(value_col, "_h1"), keys, "_h0", "_pos")
    right = row_number(base.select(*keys, "_h1", value_col), keys, "_h1", "_pos")
    out = left.join(right.select(*keys, "_pos", value_col), [*keys, "_pos"])
    return out.drop("_h0", "_pos")
