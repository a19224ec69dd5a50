"""Order-dependent statistics that stay distributed when one key is huge.

Spark's ``Window.partitionBy(key).orderBy(x)`` and the exact ``percentile``
aggregate both send every row of a key to one task.  With a key that can hold
a third of all rows that task becomes the job.  ``ordered_scan`` instead

1. range-partitions on ``(keys, order)`` -- a hot key is split across as many
   tasks as its share of the data needs -- sorts within partitions, stamps the
   partition id into the rows and checkpoints the result to the shared
   checkpoint folder (partition contents are then fixed, also when executors
   are lost and tasks are retried);
2. runs one vectorized pass per partition that emits, for the first and the
   last key of the partition only, the partition's weight totals and last
   order value (at most two rows per partition);
3. turns those <= 2 x partitions rows into carry-in offsets with a window over
   that small table and broadcasts them (size bound: 2 x partitions rows);
4. runs a second vectorized pass computing in-partition exclusive prefix sums
   and previous order values and adds the carry-in through a broadcast join.

The result is exact: ``_before_<w>`` is the sum of ``w`` over all rows of the
same key that sort strictly earlier (ties in ``order`` are ordered
arbitrarily), ``_prev`` the previous row's ``order`` value within the key.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

PID = "_pid"


def _run_starts(pdf: pd.DataFrame, keys: Sequence[str], carry_key) -> np.ndarray:
    """Boolean mask: row starts a new key run (first row compares with carry)."""
    n = len(pdf)
    same = np.ones(n, dtype=bool)
    for i, k in enumerate(keys):
        values = pdf[k].to_numpy()
        eq = np.empty(n, dtype=bool)
        eq[1:] = values[1:] == values[:-1]
        eq[0] = carry_key is not None and values[0] == carry_key[i]
        same &= eq
    return ~same


def _segment_first_index(starts: np.ndarray) -> np.ndarray:
    idx = np.where(starts, np.arange(len(starts)), 0)
    return np.maximum.accumulate(idx)


def _summary_fn(keys, order, weights):
    def run(batches):
        pid = None
        first_key = last_key = None
        first_tot = last_tot = None
        first_last_order = last_order = None
        first_open = True
        for pdf in batches:
            if pdf.empty:
                continue
            p = pdf[PID].iat[0]
            if pid is None:
                pid = p
            elif (pdf[PID] != pid).any():
                raise RuntimeError("ordered_scan: partition contents changed under the scan")
            starts = _run_starts(pdf, keys, last_key)
            start_idx = np.flatnonzero(starts)
            bounds = np.r_[0, start_idx] if (len(start_idx) == 0 or start_idx[0] != 0) else start_idx
            ends = np.r_[bounds[1:], len(pdf)] - 1
            wsum = np.stack([np.add.reduceat(pdf[w].to_numpy(dtype=np.float64), bounds)
                             for w in weights]) if weights else np.zeros((0, len(bounds)))
            orders = pdf[order].to_numpy()[ends]
            key_of = lambda r: tuple(pdf[k].iat[bounds[r]] for k in keys)  # noqa: E731, B023

            def close():
                nonlocal first_open, first_tot, first_last_order
                if first_open and last_key == first_key:
                    first_open, first_tot, first_last_order = False, last_tot, last_order

            # only the batch's first and last run can reach beyond it
            if not starts[0]:
                last_tot = last_tot + wsum[:, 0]
            else:
                if last_key is not None:
                    close()
                last_key, last_tot = key_of(0), wsum[:, 0].copy()
                first_key = last_key if first_key is None else first_key
            last_order = orders[0]
            if len(bounds) > 1:
                close()
                last_key, last_tot, last_order = key_of(len(bounds) - 1), wsum[:, -1].copy(), orders[-1]
        if pid is None:
            return
        if first_open:
            first_tot, first_last_order = last_tot, last_order
        rows = [(first_key, first_tot, first_last_order)]
        if last_key != first_key:
            rows.append((last_key, last_tot, last_order))
        out = {PID: [pid] * len(rows)}
        for i, k in enumerate(keys):
            out[k] = [r[0][i] for r in rows]
        for j, w in enumerate(weights):
            out[f"_tot_{w}"] = [float(r[1][j]) for r in rows]
        out["_last_order"] = [r[2] for r in rows]
        yield pd.DataFrame(out)
    return run


def _local_fn(keys, order, weights, with_prev):
    def run(batches):
        carry_key = None
        carry_sums = np.zeros(len(weights))
        carry_order = None
        for pdf in batches:
            if pdf.empty:
                continue
            n = len(pdf)
            starts = _run_starts(pdf, keys, carry_key)
            first = _segment_first_index(starts)
            continues = not starts[0]
            in_first_run = first == 0
            for j, w in enumerate(weights):
                vals = pdf[w].to_numpy(dtype=np.float64)
                excl = np.cumsum(vals) - vals
                local = excl - excl[first]
                if continues:
                    local = local + np.where(in_first_run, carry_sums[j], 0.0)
                pdf[f"_lb_{w}"] = local
                last_start = first[-1]
                run_total = vals[last_start:].sum()
                if continues and last_start == 0:
                    carry_sums[j] = carry_sums[j] + run_total
                else:
                    carry_sums[j] = run_total
            if with_prev:
                ov = pdf[order].to_numpy(dtype=np.float64)
                prev = np.empty(n, dtype=np.float64)
                prev[1:] = ov[:-1]
                prev[0] = np.nan
                prev[starts] = np.nan
                if continues and carry_order is not None:
                    prev[0] = carry_order
                pdf["_lprev"] = prev
                carry_order = ov[-1]
            carry_key = tuple(pdf[k].iat[n - 1] for k in keys)
            yield pdf
    return run


def ordered_scan(df: DataFrame, keys: Sequence[str], order: str,
                 weights: Sequence[str] = (), with_prev: bool = False,
                 num_partitions: int | None = None, with_totals: bool = False) -> DataFrame:
    """Exclusive prefix sums of ``weights`` and previous ``order`` value within
    ``keys`` along ``order``, distributed even for a single huge key.

    Adds ``_before_<w>`` (double) per weight and, with ``with_prev``,
    ``_prev`` (double; NULL on the first row of a key).  ``order`` must be
    numeric when ``with_prev`` is set.  Rows with NULL ``order`` should be
    removed by the caller.

    ``with_totals`` also adds ``_total_<w>`` and ``_rows``, the sums and the row
    count of the whole key, and drops rows with a NULL key.  They are joined on
    (partition, key): a hot key stays spread over the partitions of the scan.
    """
    keys = list(keys)
    weights = list(weights)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    part_cols = [F.col(c) for c in (*keys, order)]
    ranged = (df.repartitionByRange(num_partitions, *part_cols) if num_partitions
              else df.repartitionByRange(*part_cols))
    ranged = (ranged.sortWithinPartitions(*part_cols)
              .withColumn(PID, F.spark_partition_id())
              .checkpoint(eager=True))

    key_fields = [ranged.schema[k] for k in keys]
    order_field = ranged.schema[order]
    summary_schema = T.StructType(
        [T.StructField(PID, T.IntegerType())]
        + [T.StructField(f.name, f.dataType) for f in key_fields]
        + [T.StructField(f"_tot_{w}", T.DoubleType()) for w in weights]
        + [T.StructField("_last_order", order_field.dataType)])
    summary = ranged.mapInPandas(_summary_fn(keys, order, weights), summary_schema)

    by_key = Window.partitionBy(*keys).orderBy(PID)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        PID, *keys,
        *[F.coalesce(F.sum(f"_tot_{w}").over(before), F.lit(0.0)).alias(f"_off_{w}")
          for w in weights],
        *([F.lag("_last_order").over(by_key).cast("double").alias("_carry_prev")]
          if with_prev else []))

    local_schema = T.StructType(
        list(ranged.schema.fields)
        + [T.StructField(f"_lb_{w}", T.DoubleType()) for w in weights]
        + ([T.StructField("_lprev", T.DoubleType())] if with_prev else []))
    local = ranged.mapInPandas(_local_fn(keys, order, weights, with_prev), local_schema)

    joined = local.join(F.broadcast(carry), on=[PID, *keys], how="left")
    out_cols = [F.col(c) for c in df.columns]
    out_cols += [(F.col(f"_lb_{w}") + F.coalesce(F.col(f"_off_{w}"), F.lit(0.0))).alias(f"_before_{w}")
                 for w in weights]
    if with_prev:
        out_cols.append(F.coalesce(F.nanvl(F.col("_lprev"), F.lit(None).cast("double")),
                                   F.col("_carry_prev")).alias("_prev"))
    if with_totals:
        parts = ranged.groupBy(PID, *keys).agg(*[F.sum(w).alias(f"_part_{w}") for w in weights],
                                               F.count(F.lit(1)).alias("_part_rows"))
        whole = Window.partitionBy(*keys)              # a key has one row per partition here
        totals = parts.select(PID, *keys, *[F.sum(f"_part_{w}").over(whole).alias(f"_total_{w}") for w in weights],
                              F.sum("_part_rows").over(whole).alias("_rows"))
        joined = joined.join(totals, on=[PID, *keys])
        out_cols += [F.col(f"_total_{w}") for w in weights] + [F.col("_rows")]
    return joined.select(*out_cols)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[tuple[str, float]]) -> DataFrame:
    """Exact linearly interpolated quantiles of ``value`` per ``keys``.

    Same definition as pandas ``quantile`` / DuckDB ``quantile_cont``:
    position ``q*(n-1)`` over the sorted non-NULL values, interpolated
    between its floor and ceiling.  Ties are pre-aggregated (map-side) into
    counts, so the ranked table has one row per distinct value per key.
    Also returns ``n_values`` (non-NULL count) and ``n_distinct`` per key.
    """
    keys = list(keys)
    counted = (df.where(F.col(value).isNotNull())
               .groupBy(*keys, value).agg(F.count(F.lit(1)).cast("double").alias("_w")))
    ranked = (ordered_scan(counted, keys, value, weights=["_w"], with_totals=True)
              .withColumnsRenamed({"_total__w": "_n", "_rows": "_nd"}))
    lo_hits, aggs = [], []
    for name, q in probs:
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        hit_lo = (lo >= F.col("_before__w")) & (lo < F.col("_before__w") + F.col("_w"))
        hit_hi = (hi >= F.col("_before__w")) & (hi < F.col("_before__w") + F.col("_w"))
        lo_hits += [hit_lo, hit_hi]
        aggs += [F.max(F.when(hit_lo, F.col(value))).alias(f"_lo_{name}"),
                 F.max(F.when(hit_hi, F.col(value))).alias(f"_hi_{name}")]
    cond = lo_hits[0]
    for c in lo_hits[1:]:
        cond = cond | c
    picked = ranked.where(cond).groupBy(*keys).agg(F.first("_n").alias("_n"),
                                                   F.first("_nd").alias("_nd"), *aggs)
    outs = []
    for name, q in probs:
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        frac = pos - F.floor(pos)
        lo_v, hi_v = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        outs.append((lo_v + (hi_v - lo_v) * frac).alias(name))
    return picked.select(*keys, *outs, F.col("_n").cast("long").alias("n_values"),
                         F.col("_nd").alias("n_distinct"))
