"""Tables over the trace of the greedy family search.

A trace has a row per round and family offered: ``round, family, n_columns,
mean, std, score, accepted``; a few dozen rows, whatever the data.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(trace: DataFrame) -> DataFrame:
    """Each row with the running number of its family's rounds."""
    return trace.withColumn("family_round", F.row_number().over(Window.partitionBy("family").orderBy("round")))


def first_round(trace: DataFrame) -> DataFrame:
    """Families alone, best first, ties by name."""
    best = Window.partitionBy("round").orderBy(F.desc("score"), "family")
    return (trace.where(F.col("round") == 1).withColumn("place", F.row_number().over(best))
            .select("place", "family", "n_columns", "mean", "score").orderBy("place"))


def ablation(trace: DataFrame) -> DataFrame:
    """Family, columns, mean and what became of it, round by round."""
    return trace.select("round", "family", "n_columns", "mean",
                        F.when(F.col("accepted"), F.lit("kept")).otherwise(F.lit("rejected")).alias("verdict"))


def verdict(trace: DataFrame) -> DataFrame:
    """Families at or below chance in some round, families tried but not kept."""
    return trace.agg(F.count_distinct(F.when(F.col("score") <= 0.5, F.col("family"))).alias("chance_families"),
                     (F.count_distinct("family") - F.count_distinct(F.when(F.col("accepted"), F.col("family"))))
                     .alias("rejected_families"))
