"""The nine feature families and ``build_features``.

Design: one scan of the history and one aggregation per alert.  Every
statistic of every family is an aggregate expression in a single
``groupBy(alert_id)``.  Families without an order (base, direction_type, cross,
flow, windows, hour) are pre-reduced on every mapper.  Gaps between consecutive
transactions need the rows of an alert together and in time order: the history
is exchanged by alert once, the lag, the exact percentiles and all other
aggregates follow in the same stage.

That holds the rows of an alert in one task, which is right for all but hot
alerts.  Alerts of over ``HOT_ROWS`` rows are found first by a count and take the
distributed way instead: ``ordered_scan`` and ``exact_quantiles`` range-partition
them, so that one alert never has to fit one task.  Both ways give the same
columns and are united; nothing is dropped or capped.

Aggregation buffers are kept lean (means are sum / count of buffers that exist
anyway, shares are sums over the row count, identical aggregates are shared by
Catalyst).  The per-alert frame is joined to the de-duplicated alert index, and the
null contract is applied last:

* count-like columns are 0 when nothing matched;
* alerts without any transaction ("silent") are NULL in every other column
  except the alert-date ones (they come out of the left join as NULL);
* an alert with transactions but none in a category gets sum 0, mean NULL;
* divisions by zero and non-finite values become NULL.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (MICROS_PER_HOUR, bias_corrected_kurt, bias_corrected_skew,
                                 epoch_micros, flag, safe_div)
from ..schema import (ALERT_DATE, ALERT_ID, AMOUNT, AMOUNT_QUANTILES, BIG_AMOUNT, DIRECTION,
                      DIRECTIONS, FAMILIES, TX_TS, TX_TYPE, TX_TYPES, WINDOWS, is_count_column)
from ..session import ensure_checkpoint_dir
from .ordered import exact_quantiles, ordered_scan
from .prepare import dedup_alerts

N = "_n"          # rows per alert (all rows, also those with NULL amount)
#: an alert with more rows is spread over tasks where its rows are needed in order
HOT_ROWS = 250_000
GAP_QUANTILES = (("burst_gap_med", 0.5), ("burst_gap_q90", 0.9))


def _ad() -> tuple[Column, Column]:
    return F.col(AMOUNT), F.col("days_before")


def _sum0(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0))


# ---------------------------------------------------------------- families
# Each family: (aggregates over the history, output columns over the
# aggregated frame).  Output order is the family's column order.

def _base():
    A, D = _ad()
    aggs = [F.count(A).alias("base_cnt"), F.sum(A).alias("_sum_a"),
            F.stddev_samp(A).alias("base_std"), F.min(A).alias("base_min"),
            F.max(A).alias("base_max"), F.max(D).alias("_max_d"), F.min(D).alias("_min_d")]
    outs = [F.col("base_cnt"), safe_div(F.col("_sum_a"), F.col("base_cnt")).alias("base_mean"),
            F.col("base_std"), F.col("base_min"), F.col("base_max"),
            F.coalesce(F.col("_sum_a"), F.lit(0.0)).alias("base_sum"),
            (F.col("_max_d") - F.col("_min_d")).alias("base_span")]
    return aggs, outs


def _amount_shape():
    A, D = _ad()
    aggs = [bias_corrected_skew(A).alias("amt_skew"), bias_corrected_kurt(A).alias("amt_kurt"),
            F.sum(flag(A > BIG_AMOUNT)).alias("_big")]
    q = {name: F.col(name) for name, _ in AMOUNT_QUANTILES}
    outs = [q["amt_med"], q["amt_q10"], q["amt_q25"], q["amt_q75"], q["amt_q90"], q["amt_q99"],
            (q["amt_q75"] - q["amt_q25"]).alias("amt_iqr"), F.col("amt_skew"), F.col("amt_kurt"),
            safe_div(F.col("_big"), F.col(N)).alias("amt_big_share"),
            safe_div(F.col("_amt_nuniq"), F.col(N)).alias("amt_nuniq_ratio")]
    return aggs, outs


def _direction_type():
    A, D = _ad()
    aggs, outs = [], []
    for column, prefix, cats in ((DIRECTION, "dir", DIRECTIONS), (TX_TYPE, "ty", TX_TYPES)):
        for c in cats:
            hit = F.col(column) == c
            aggs += [F.count_if(hit).alias(f"{prefix}_n_{c}"),
                     F.sum(F.when(hit, A)).alias(f"_{prefix}_sum_{c}"),
                     F.count(F.when(hit, A)).alias(f"_{prefix}_cnt_{c}")]
            outs += [F.col(f"{prefix}_n_{c}"),
                     safe_div(F.col(f"_{prefix}_sum_{c}"), F.col(f"_{prefix}_cnt_{c}")).alias(f"{prefix}_m_{c}"),
                     F.coalesce(F.col(f"_{prefix}_sum_{c}"), F.lit(0.0)).alias(f"{prefix}_s_{c}"),
                     safe_div(F.col(f"{prefix}_n_{c}"), F.col(N)).alias(f"{prefix}_sh_{c}")]
    return aggs, outs


def _cross():
    aggs, outs = [], []
    for d in DIRECTIONS:
        for t in TX_TYPES:
            name = f"cross_n_{d}_{t}"
            aggs.append(F.count_if((F.col(DIRECTION) == d) & (F.col(TX_TYPE) == t)).alias(name))
            outs += [F.col(name), safe_div(F.col(name), F.col(N)).alias(f"cross_sh_{d}_{t}")]
    return aggs, outs


def _flow():
    A, D = _ad()
    inc, outg = F.col("out") == 0, F.col("out") == 1
    aggs = [F.sum(F.when(inc, A)).alias("_in_sum"), F.sum(F.when(outg, A)).alias("_out_sum"),
            F.count(F.when(inc, A)).alias("_in_cnt"), F.count(F.when(outg, A)).alias("_out_cnt")]
    in_sum = F.coalesce(F.col("_in_sum"), F.lit(0.0))
    out_sum = F.coalesce(F.col("_out_sum"), F.lit(0.0))
    outs = [(in_sum - out_sum).alias("flow_net"),
            safe_div(out_sum, F.abs(in_sum) + F.lit(1e-6)).alias("flow_ratio"),
            safe_div(F.col("_out_cnt"), F.col("_in_cnt") + 1).alias("flow_cnt_ratio"),
            (safe_div(F.col("_in_sum"), F.col("_in_cnt"))
             - safe_div(F.col("_out_sum"), F.col("_out_cnt"))).alias("flow_mean_gap")]
    return aggs, outs


def _windows():
    A, D = _ad()
    aggs, outs = [], []
    for w in WINDOWS:
        inside = D <= F.lit(float(w))
        aggs += [F.count_if(inside).alias(f"win_n{w}"),
                 F.sum(F.when(inside, A)).alias(f"_wsum{w}"),
                 F.count(F.when(inside, A)).alias(f"_wcnt{w}"),
                 F.max(F.when(inside, A)).alias(f"win_max{w}"),
                 F.sum(F.when(inside, F.col("out"))).alias(f"_wout{w}")]
        outs += [F.col(f"win_n{w}"), F.coalesce(F.col(f"_wsum{w}"), F.lit(0.0)).alias(f"win_sum{w}"),
                 safe_div(F.col(f"_wsum{w}"), F.col(f"_wcnt{w}")).alias(f"win_mean{w}"),
                 F.col(f"win_max{w}"),
                 safe_div(F.col(f"_wout{w}"), F.col(f"win_n{w}")).alias(f"win_out{w}"),
                 safe_div(F.col(f"win_n{w}"), F.col(N) + 1).alias(f"win_rate{w}")]
    aggs += [F.min(D).alias("win_recency"), F.max(D).alias("win_oldest")]
    outs += [safe_div(F.col("win_n7"), F.col("win_n30") / 4 + F.lit(0.1)).alias("win_accel_7_30"),
             safe_div(F.col("win_n30"), F.col("win_n90") / 3 + F.lit(0.1)).alias("win_accel_30_90"),
             F.col("win_recency"), F.col("win_oldest")]
    return aggs, outs


def _burst():
    outs = [F.col("burst_gap_mean"), F.col("burst_gap_std"), F.col("burst_gap_min"),
            F.col("burst_gap_med"), F.col("burst_gap_q90"),
            safe_div(F.col("burst_gap_std"), F.col("burst_gap_mean") + F.lit(1e-6)).alias("burst_cv"),
            F.col("burst_under_1h")]
    return [], outs


def _hour():
    aggs = [F.sum("night").alias("_night"), F.sum("weekend").alias("_weekend"),
            F.avg("hour").alias("hour_mean"), F.stddev_samp("hour").alias("hour_std")]
    outs = [safe_div(F.col("_night"), F.col(N)).alias("hour_night_share"),
            safe_div(F.col("_weekend"), F.col(N)).alias("hour_weekend_share"), F.col("hour_mean"),
            F.col("hour_std"), F.col("hour_dow_nuniq"), F.col("hour_active_days"),
            safe_div(F.col(N), F.col("hour_active_days")).alias("hour_tx_per_active_day")]
    return aggs, outs


def _signal_date():
    outs = [F.col("sig_month"), F.col("sig_dow"), F.col("sig_day"), F.col("sig_week"),
            F.col("sig_tnum"), F.col("sig_same_day_n")]
    return [], outs


FAMILY_BUILDERS = {
    "base": _base, "amount_shape": _amount_shape, "direction_type": _direction_type,
    "cross": _cross, "flow": _flow, "windows": _windows, "burst": _burst,
    "hour": _hour, "signal_date": _signal_date,
}


def family_columns(name: str) -> list[str]:
    """Output column names of one family, in order (no data or session needed)."""
    if name == "base":
        return ["base_cnt", "base_mean", "base_std", "base_min", "base_max", "base_sum", "base_span"]
    if name == "amount_shape":
        return [n for n, _ in AMOUNT_QUANTILES] + ["amt_iqr", "amt_skew", "amt_kurt",
                                                   "amt_big_share", "amt_nuniq_ratio"]
    if name == "direction_type":
        return [f"{p}_{k}_{c}" for p, cats in (("dir", DIRECTIONS), ("ty", TX_TYPES))
                for c in cats for k in ("n", "m", "s", "sh")]
    if name == "cross":
        return [f"cross_{k}_{d}_{t}" for d in DIRECTIONS for t in TX_TYPES for k in ("n", "sh")]
    if name == "flow":
        return ["flow_net", "flow_ratio", "flow_cnt_ratio", "flow_mean_gap"]
    if name == "windows":
        return ([f"win_{k}{w}" for w in WINDOWS for k in ("n", "sum", "mean", "max", "out", "rate")]
                + ["win_accel_7_30", "win_accel_30_90", "win_recency", "win_oldest"])
    if name == "burst":
        return ["burst_gap_mean", "burst_gap_std", "burst_gap_min", "burst_gap_med",
                "burst_gap_q90", "burst_cv", "burst_under_1h"]
    if name == "hour":
        return ["hour_night_share", "hour_weekend_share", "hour_mean", "hour_std",
                "hour_dow_nuniq", "hour_active_days", "hour_tx_per_active_day"]
    if name == "signal_date":
        return ["sig_month", "sig_dow", "sig_day", "sig_week", "sig_tnum", "sig_same_day_n"]
    raise KeyError(name)


def feature_columns(families: Sequence[str] | None = None) -> list[str]:
    return [c for f in (families or FAMILIES) for c in family_columns(f)]


# ------------------------------------------------------- per-alert frames

def gap_history(history: DataFrame) -> DataFrame:
    """Hours since the alert's previous transaction, per transaction (NULL first).

    Distributed lag: ``ordered_scan`` over (alert_id, tx time) -- no
    per-alert window, so one alert never has to fit one task."""
    keyed = history.select(ALERT_ID, epoch_micros(TX_TS).alias("_ts_us"))
    scanned = ordered_scan(keyed, [ALERT_ID], "_ts_us", with_prev=True)
    return scanned.select(ALERT_ID, ((F.col("_ts_us") - F.col("_prev")) / MICROS_PER_HOUR).alias("gap"))


def hot_alerts(history: DataFrame, hot_rows: int) -> DataFrame | None:
    """Ids of the alerts of more than ``hot_rows`` rows; None if there is none."""
    ensure_checkpoint_dir(history.sparkSession)
    ids = (history.groupBy(ALERT_ID).agg(F.count(F.lit(1)).alias(N)).where(F.col(N) > hot_rows)
           .select(ALERT_ID).checkpoint())
    return None if ids.isEmpty() else ids


def _day_aggs(names: Sequence[str]) -> list[Column]:
    """Distinct days and weekdays; a calendar bounds the sets."""
    if "hour" not in names:
        return []
    return [F.size(F.collect_set("tx_date")).cast("long").alias("hour_active_days"),
            F.size(F.collect_set("dow")).cast("long").alias("hour_dow_nuniq")]


def _gap_aggs() -> list[Column]:
    return [F.avg("gap").alias("burst_gap_mean"), F.stddev_samp("gap").alias("burst_gap_std"),
            F.min("gap").alias("burst_gap_min"), F.avg(flag(F.col("gap") < 1)).alias("burst_under_1h")]


def _in_one_task(history: DataFrame, aggs: Sequence[Column], names: Sequence[str]) -> DataFrame:
    """All aggregates per alert, the rows of an alert being in one task."""
    A, _ = _ad()
    aggs, pick = [*aggs, *_day_aggs(names)], {}
    if "burst" in names:
        in_time = Window.partitionBy(ALERT_ID).orderBy("_ts_us")
        history = history.withColumn("_ts_us", epoch_micros(TX_TS)).withColumn(
            "gap", (F.col("_ts_us") - F.lag("_ts_us").over(in_time)) / MICROS_PER_HOUR)
        aggs += [*_gap_aggs(), F.percentile("gap", [q for _, q in GAP_QUANTILES]).alias("_gap_q")]
        pick |= {name: F.col("_gap_q")[i] for i, (name, _) in enumerate(GAP_QUANTILES)}
    if "amount_shape" in names:
        aggs += [F.percentile(A, [q for _, q in AMOUNT_QUANTILES]).alias("_amt_q"),
                 F.size(F.collect_set(A + F.lit(0.0))).cast("long").alias("_amt_nuniq")]
        pick |= {name: F.col("_amt_q")[i] for i, (name, _) in enumerate(AMOUNT_QUANTILES)}
    return history.groupBy(ALERT_ID).agg(*aggs).withColumns(pick).drop("_gap_q", "_amt_q")


def _spread(history: DataFrame, aggs: Sequence[Column], names: Sequence[str]) -> DataFrame:
    """The same columns of hot alerts, with their rows spread over tasks."""
    A, _ = _ad()
    frame = history.groupBy(ALERT_ID).agg(*aggs, *_day_aggs(names))
    if "burst" in names:
        gaps = gap_history(history)
        quantiles = exact_quantiles(gaps, [ALERT_ID], "gap", GAP_QUANTILES).drop("n_values", "n_distinct")
        frame = frame.join(gaps.groupBy(ALERT_ID).agg(*_gap_aggs()), ALERT_ID, "left").join(quantiles, ALERT_ID, "left")
    if "amount_shape" in names:
        # distinct amounts fall out of the (alert, value) pre-aggregation
        quantiles = exact_quantiles(history.select(ALERT_ID, A), [ALERT_ID], AMOUNT, AMOUNT_QUANTILES)
        frame = frame.join(quantiles.withColumnRenamed("n_distinct", "_amt_nuniq").drop("n_values"), ALERT_ID, "left")
        frame = frame.withColumn("_amt_nuniq", F.coalesce("_amt_nuniq", F.lit(0)).cast("long"))
    return frame


def per_alert(history: DataFrame, names: Sequence[str], aggs: Sequence[Column], hot_rows: int) -> DataFrame:
    """One row per alert with transactions: the aggregates of all families asked for."""
    in_order = {"burst", "amount_shape"} & set(names)
    hot = hot_alerts(history, hot_rows) if in_order else None
    if hot is None:
        return _in_one_task(history, aggs, names)
    return _in_one_task(history.join(hot, ALERT_ID, "left_anti"), aggs, names).unionByName(
        _spread(history.join(hot, ALERT_ID, "left_semi"), aggs, names))


def signal_date_frame(index: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Calendar fields of the alert date, anchored to the reference split."""
    anchor = dedup_alerts((reference if reference is not None else index).select(ALERT_ID, ALERT_DATE))
    first_day = anchor.agg(F.min(ALERT_DATE)).scalar()
    same_day = anchor.groupBy(ALERT_DATE).agg(F.count(F.lit(1)).alias("sig_same_day_n"))
    dated = index.select(ALERT_ID, ALERT_DATE).join(same_day, ALERT_DATE, "left")
    return dated.select(
        ALERT_ID,
        F.month(ALERT_DATE).alias("sig_month"), F.weekday(ALERT_DATE).alias("sig_dow"),
        F.dayofmonth(ALERT_DATE).alias("sig_day"), F.weekofyear(ALERT_DATE).cast("double").alias("sig_week"),
        F.datediff(F.to_date(ALERT_DATE), F.to_date(first_day)).alias("sig_tnum"),
        F.col("sig_same_day_n"))


def build_features(history: DataFrame, alerts: DataFrame,
                   families: Sequence[str] | None = None,
                   reference: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per unique alert id: ``alert_id`` + the families' columns."""
    names = list(families) if families is not None else list(FAMILIES)
    unknown = set(names) - set(FAMILY_BUILDERS)
    if unknown:
        raise KeyError(f"unknown families: {sorted(unknown)}")
    index = dedup_alerts(alerts.select(ALERT_ID, ALERT_DATE))
    built = {n: FAMILY_BUILDERS[n]() for n in names}
    aggs = [F.count(F.lit(1)).alias(N)] + [a for n in names for a in built[n][0]]

    frame = index.select(ALERT_ID).join(per_alert(history, names, aggs, hot_rows), ALERT_ID, "left")
    if "signal_date" in names:
        frame = frame.join(signal_date_frame(index, reference), ALERT_ID, "left")

    outs = [c for n in names for c in built[n][1]]
    shaped = frame.select(ALERT_ID, *outs, F.col(N))
    expected = [ALERT_ID] + feature_columns(names)
    if shaped.columns[:-1] != expected:
        raise AssertionError(f"family column listing out of sync: {shaped.columns} vs {expected}")
    # silent alerts (no row survived the date filter) have NULL _n after the
    # left join; a 0-filled sum is a reachable value, so they are masked here
    has_rows = F.col(N).isNotNull()
    final = []
    for field in shaped.schema.fields[:-1]:
        c = F.col(field.name)
        if field.name == ALERT_ID:
            final.append(c)
        elif is_count_column(field.name):
            final.append(F.coalesce(c, F.lit(0)).cast("long").alias(field.name))
        elif field.name.startswith("sig_"):
            final.append(c)
        elif field.dataType.typeName() == "double":
            finite = F.when(F.isnan(c) | F.abs(c).eqNullSafe(F.lit(float("inf"))),
                            F.lit(None).cast("double")).otherwise(c)
            final.append(F.when(has_rows, finite).alias(field.name))
        else:
            final.append(F.when(has_rows, c).alias(field.name))
    return shaped.select(*final)
