"""Quantiles of few, large groups (E5, E6, E13, M3): exact ones by radix refinement, approximate ones by sketches.

An outcome or a column holds a large share of all rows, so its quantiles may
neither sort it in one task nor collect it.  ``radix_quantiles`` narrows each
wanted rank to the bucket that holds it, by the leading bits of the values:

1. the bits of a double, with the sign folded in, sort like the double;
2. rows are counted by (key, leading 16 bits), with map-side aggregation;
3. the bucket of each rank is found in those counts, and only its rows are
   counted by their next 16 bits, until a bucket holds one value.

That takes four passes at most, whatever the values: a bucket whose smallest and
largest value agree is done, and one of up to 65,536 rows is counted by value
at once.  Rows are projected to (key, value, bits) and written once; they are
neither sorted nor exchanged.  What is exchanged are counts, at most 65,536 a
key, a task and a pass.

``sketch_state`` keeps a KLL sketch instead, which can be stored for each day
and merged later.  It is chosen by the caller, never by the size of the data.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written_once

#: bits of a pass, and the bits left out of the first
DIGIT, FIRST_SHIFT = 16, 48
MANTISSA = 1 << 52
SMALLEST_NORMAL = 2.0 ** -1022
#: size parameter of the sketches, and a bound on their rank error that holds with 99 % confidence
SKETCH_K = 2048
SKETCH_RANK_ERROR = 0.005


def sortable_bits(value: Column) -> Column:
    """A long that sorts like the double ``value``: its IEEE bits, negated for negative numbers.

    Computed from exponent and mantissa.  Scaling by a power of two is exact, so
    only the exponent's logarithm can be off by one, which is put right."""
    size = F.abs(value)
    guess = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    part = size / F.pow(F.lit(2.0), guess.cast("double"))
    exponent = F.when(part < 1, guess - 1).when(part >= 2, guess + 1).otherwise(guess)
    mantissa = F.when(part < 1, part * 2).when(part >= 2, part / 2).otherwise(part)
    normal = (exponent + 1023) * F.lit(MANTISSA) + ((mantissa - 1) * F.lit(float(MANTISSA))).cast("long")
    bits = (F.when(size == 0, F.lit(0).cast("long"))
            .when(size == float("inf"), F.lit(2047 * MANTISSA))
            .when(size < SMALLEST_NORMAL, (size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long"))
            .otherwise(normal))
    return F.when(value < 0, -bits).otherwise(bits)


def radix_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[tuple[str, float]]) -> DataFrame:
    """Exact linearly interpolated quantiles of ``value`` per ``keys``, and ``n_values``.

    Position ``q * (n - 1)`` over the sorted values, interpolated between its
    floor and its ceiling, as pandas and DuckDB do.  NULL and NaN values are not
    counted; a key without values, or a NULL key, has no row.
    """
    keys = list(keys)
    named = reduce(lambda c, k: c & F.col(k).isNotNull(), keys, F.lit(True))
    rows = written_once(df.select(*keys, F.col(value).cast("double").alias("_v"))
                        .where(named & F.col("_v").isNotNull() & ~F.isnan("_v"))
                        .withColumn("_s", sortable_bits(F.col("_v"))))
    targets, found, shift = None, [], FIRST_SHIFT
    while targets is None or shift is not None:
        if targets is None:
            counts = _counts(rows, keys, shift)
            whole = Window.partitionBy(*keys)
            held = (counts.withColumn("_n", F.sum("_rows").over(whole))
                    .withColumn("_end", F.sum("_rows").over(whole.orderBy("_prefix")))
                    .select("*", F.inline(_ranks(probs))))
        else:
            inside = [*keys, "_parent"]
            part = rows.withColumn("_parent", F.shiftright("_s", parent)).join(targets.select(inside).distinct(), inside)
            counts = _counts(part, inside, shift)
            held = targets.join(counts.withColumn("_end", F.sum("_rows").over(Window.partitionBy(*inside).orderBy("_prefix"))), inside)
        start = F.col("_end") - F.col("_rows")
        held = (held.where((F.col("_rank") >= start) & (F.col("_rank") < F.col("_end")))
                .select(*keys, "_n", "_name", "_side", (F.col("_rank") - start).alias("_rank"),
                        F.col("_prefix").alias("_parent"), "_rows", "_lo", "_hi").checkpoint())
        found.append(held.where(F.col("_lo") == F.col("_hi")).select(*keys, "_n", "_name", "_side", "_lo"))
        still = held.where(F.col("_lo") != F.col("_hi"))
        targets = still.drop("_lo", "_hi", "_rows")
        # a bucket of few rows has few values: count them all at once
        parent, most = shift, still.agg(F.max("_rows")).first()[0]
        shift = None if most is None else 0 if most <= 1 << DIGIT else max(shift - DIGIT, 0)
    at = [F.max(F.when((F.col("_name") == name) & (F.col("_side") == side), F.col("_lo"))).alias(f"_{side}_{name}")
          for name, _ in probs for side in (0, 1)]
    picked = reduce(DataFrame.unionByName, found).groupBy(*keys, "_n").agg(*at)
    outs = []
    for name, q in probs:
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        lo, hi = F.col(f"_0_{name}"), F.col(f"_1_{name}")
        outs.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return picked.select(*keys, *outs, F.col("_n").alias("n_values"))


def _counts(rows: DataFrame, keys: Sequence[str], shift: int) -> DataFrame:
    """Rows, smallest and largest value of each (key, prefix)."""
    return rows.groupBy(*keys, F.shiftright("_s", shift).alias("_prefix")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))


def _ranks(probs: Sequence[tuple[str, float]]) -> Column:
    """The ranks below and above each quantile of ``_n`` values."""
    return F.array(*[F.struct(F.lit(name).alias("_name"), F.lit(side).alias("_side"),
                              (F.ceil if side else F.floor)(F.lit(float(q)) * (F.col("_n") - 1)).cast("long").alias("_rank"))
                     for name, q in probs for side in (0, 1)])


# ------------------------------------------------------------------ sketches

def sketch_state(df: DataFrame, keys: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """``keys`` and the KLL sketch ``state`` of the values; NULL and NaN are not counted.

    Store it with the day among the keys, and merge what is needed later."""
    v = F.col(value).cast("double")
    return (df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys)
            .agg(F.kll_sketch_agg_double(v, F.lit(k)).alias("state")))


def merge_sketches(states: DataFrame, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One sketch per ``keys`` from stored states of finer keys."""
    return states.groupBy(*keys).agg(F.kll_merge_agg_double("state", F.lit(k)).alias("state"))


def sketch_quantiles(states: DataFrame, keys: Sequence[str], probs: Sequence[tuple[str, float]]) -> DataFrame:
    """Approximate quantiles of stored states, and ``n_values``; ranks are off by SKETCH_RANK_ERROR of n at most."""
    return states.select(*keys, *[F.kll_sketch_get_quantile_double("state", F.lit(float(q))).alias(name) for name, q in probs],
                         F.kll_sketch_get_n_double("state").alias("n_values"))
