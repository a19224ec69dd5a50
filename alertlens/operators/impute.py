"""Median imputer: fit on one frame, apply to many; an all-NULL column -> 0 (M3).

The medians are exact (linear interpolation, like the reference's imputer):
the feature columns are unpivoted into ``(column, value)`` and narrowed down
with ``radix_quantiles`` keyed by column, without sorting or exchanging them.  The fitted surrogates are one number per column -- the only
thing brought to the driver, as Spark ML's own ``Imputer`` does.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import radix_quantiles


def long_format(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(ids), list(columns), "column", "value")


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    med = radix_quantiles(long_format(df, columns), ["column"], "value", [("median", 0.5)])
    found = {r["column"]: r["median"] for r in med.collect()}
    return {c: float(found[c]) if found.get(c) is not None else 0.0 for c in columns}


def apply_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c)
                       if c in medians else F.col(c) for c in df.columns])


def impute(fit: DataFrame, applies: Sequence[DataFrame], columns: Sequence[str]) -> list[DataFrame]:
    medians = fit_medians(fit, columns)
    return [apply_medians(a, medians) for a in applies]
