"""Exploratory aggregate tables by outcome.

Each table is its own function ``(alerts, history) -> DataFrame`` so it can
run alone.  ``alerts`` are labelled alerts, ``history`` is the prepared
history (``prepare``).  All are aggregations with partial (map-side)
aggregation; the medians use ``radix_quantiles`` because an outcome group
holds a large share of all transactions.  E5 and E13 take ``sketch=True`` for
approximate quantiles from mergeable sketches instead.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import ALERT_DATE, ALERT_ID, AMOUNT, DIRECTION, DIRECTIONS, LABEL, OUTCOMES, TX_TS, TX_TYPE, TX_TYPES
from .prepare import dedup_alerts
from .quantiles import SKETCH_RANK_ERROR, merge_sketches, radix_quantiles, sketch_quantiles, sketch_state

HIST_BUCKET_DAYS = 10
HIST_MAX_DAYS = 180


def outcome_name(label: Column) -> Column:
    expr = F.lit(None).cast("string")
    for code, name in reversed(OUTCOMES):
        expr = F.when(label == code, F.lit(name)).otherwise(expr)
    return expr


def labelled_history(alerts: DataFrame, history: DataFrame) -> DataFrame:
    """History of labelled alerts with the label attached.

    ``prepare(..., carry=[LABEL])`` has attached it already; a history without
    it is joined to the de-duplicated alerts."""
    if LABEL in history.columns:
        return history
    return history.join(dedup_alerts(alerts).select(ALERT_ID, LABEL), ALERT_ID, "inner")


def target(alerts: DataFrame) -> DataFrame:
    """Alerts per outcome, most frequent first."""
    return (alerts.where(F.col(LABEL).isNotNull())
            .groupBy(outcome_name(F.col(LABEL)).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("alerts")).orderBy(F.desc("alerts")))


def weekly_volume(history: DataFrame) -> DataFrame:
    """Transactions per week ending Sunday, zero-filled from first to last week."""
    week_end = F.date_add(F.to_date(F.date_trunc("week", F.col(TX_TS))), 6)
    counts = history.groupBy(week_end.alias("week_end")).agg(F.count(F.lit(1)).alias("transactions"))
    calendar = (counts.agg(F.min("week_end").alias("lo"), F.max("week_end").alias("hi"))
                .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("week_end")))
    return (calendar.join(counts, "week_end", "left")
            .select("week_end", F.coalesce("transactions", F.lit(0)).alias("transactions"))
            .orderBy("week_end"))


def _category_counts(history: DataFrame, column: str, categories: Sequence[str],
                     out_name: str) -> DataFrame:
    spark = history.sparkSession
    cats = spark.createDataFrame([(i, c) for i, c in enumerate(categories)], f"_pos int, {out_name} string")
    counts = history.groupBy(F.col(column).alias(out_name)).agg(F.count(F.lit(1)).alias("transactions"))
    return (cats.join(counts, out_name, "left").orderBy("_pos").select(out_name, "transactions"))


def direction_counts(history: DataFrame) -> DataFrame:
    """Transactions per frozen direction, list order; absent -> NULL."""
    return _category_counts(history, DIRECTION, DIRECTIONS, "direction")


def type_counts(history: DataFrame) -> DataFrame:
    """Transactions per frozen type, list order; unknown types dropped."""
    return _category_counts(history, TX_TYPE, TX_TYPES, "type")


def _quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[tuple[str, float]], sketch: bool) -> DataFrame:
    if sketch:
        return sketch_quantiles(sketch_state(df, keys, value), keys, probs)
    return radix_quantiles(df, keys, value, probs)


def amount_by_outcome(alerts: DataFrame, history: DataFrame, sketch: bool = False) -> DataFrame:
    """count, mean, median, std of the amount per outcome (E5)."""
    lab = labelled_history(alerts, history)
    stats = lab.groupBy(LABEL).agg(F.count(AMOUNT).alias("count"), F.avg(AMOUNT).alias("mean"),
                                   F.stddev_samp(AMOUNT).alias("std"))
    med = _quantiles(lab.select(LABEL, AMOUNT), [LABEL], AMOUNT, [("median", 0.5)], sketch)
    return (stats.join(med, LABEL, "left")
            .select(outcome_name(F.col(LABEL)).alias("outcome"), "count", "mean", "median", "std"))


def volume_by_outcome(alerts: DataFrame, history: DataFrame) -> DataFrame:
    """mean/median/min/max of transactions per alert, per outcome."""
    per_alert = (labelled_history(alerts, history).groupBy(ALERT_ID, LABEL)
                 .agg(F.count(F.lit(1)).cast("double").alias("n")))
    stats = per_alert.groupBy(LABEL).agg(F.avg("n").alias("mean"), F.min("n").alias("min"),
                                         F.max("n").alias("max"))
    med = radix_quantiles(per_alert, [LABEL], "n", [("median", 0.5)])
    return (stats.join(med, LABEL, "left")
            .select(outcome_name(F.col(LABEL)).alias("outcome"), "mean", "median", "min", "max"))


def days_before_hist(alerts: DataFrame, history: DataFrame) -> DataFrame:
    """Transactions per 10-day bucket of days_before and outcome; >= 180 dropped."""
    lab = labelled_history(alerts, history).where(F.col("days_before") < HIST_MAX_DAYS)
    bucket = (F.floor(F.col("days_before") / HIST_BUCKET_DAYS) * HIST_BUCKET_DAYS).cast("double")
    return (lab.groupBy(bucket.alias("bucket"), outcome_name(F.col(LABEL)).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("transactions")))


def type_by_outcome(alerts: DataFrame, history: DataFrame) -> DataFrame:
    """Transactions per type (unknown types kept) and outcome."""
    lab = labelled_history(alerts, history).where(F.col(TX_TYPE).isNotNull())
    return (lab.groupBy(F.col(TX_TYPE).alias("tx_type"), outcome_name(F.col(LABEL)).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("transactions")))


def days_before_share(alerts: DataFrame, history: DataFrame) -> DataFrame:
    """E7 normalised within outcome (W5) -- a window over the small aggregate."""
    hist = days_before_hist(alerts, history)
    w = Window.partitionBy("outcome")
    return hist.select("bucket", "outcome",
                       (F.col("transactions") / F.sum("transactions").over(w)).alias("share"))


def type_mix_share(alerts: DataFrame, history: DataFrame) -> DataFrame:
    """E8 pivoted by outcome, each outcome column normalised to 1."""
    names = [n for _, n in OUTCOMES]
    counts = type_by_outcome(alerts, history)
    totals = counts.groupBy("outcome").agg(F.sum("transactions").alias("_total"))
    shares = counts.join(totals, "outcome").select(
        "tx_type", "outcome", (F.col("transactions") / F.col("_total")).alias("share"))
    return shares.groupBy("tx_type").pivot("outcome", names).agg(F.first("share"))


def headline(alerts: DataFrame, history: DataFrame) -> DataFrame:
    """Escalation rate, alert count, transactions, first/last alert date."""
    tx_count = history.agg(F.count(F.lit(1))).scalar()
    return alerts.agg(F.avg(F.col(LABEL).cast("double")).alias("escalation_rate"),
                      F.count(F.lit(1)).alias("alerts"),
                      F.min(ALERT_DATE).alias("first_alert_date"),
                      F.max(ALERT_DATE).alias("last_alert_date")).select(
        "escalation_rate", "alerts", tx_count.alias("transactions"),
        "first_alert_date", "last_alert_date")


def history_profile(history: DataFrame, column: str = "days_before", sketch: bool = False) -> DataFrame:
    """``describe()`` of one column: count, mean, std, min, quartiles, max."""
    stats = history.agg(F.count(column).alias("count"), F.avg(column).alias("mean"),
                        F.stddev_samp(column).alias("std"), F.min(column).alias("min"),
                        F.max(column).alias("max")).withColumn("_all", F.lit(0))
    qs = _quantiles(history.select(F.lit(0).alias("_all"), column), ["_all"], column,
                    [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)], sketch)
    return stats.join(qs, "_all", "left").select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def daily_sketches(history: DataFrame, columns: Sequence[str] = (AMOUNT, "days_before")) -> DataFrame:
    """The stored form of approximate E5 and E13: a sketch per outcome, column and day."""
    long = history.select(LABEL, "tx_date", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [LABEL, "tx_date"], list(columns), "column", "value")
    return sketch_state(long, [LABEL, "column", "tx_date"], "value")


def sketch_check(history: DataFrame, states: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Whether the quantiles of stored daily sketches, merged over all days, have their exact ranks within the bound.

    A value's rank is right if the share of smaller values and the share of
    values up to it have the wanted share between them, give or take the bound."""
    columns = [r["column"] for r in states.select("column").distinct().collect()]
    merged = sketch_quantiles(merge_sketches(states, [LABEL, "column"]), [LABEL, "column"], [(f"q{i}", p) for i, p in enumerate(probs)])
    wanted = merged.select(LABEL, "column", "n_values", F.inline(F.array(*[
        F.struct(F.lit(p).alias("p"), F.col(f"q{i}").alias("estimate")) for i, p in enumerate(probs)])))
    long = history.select(LABEL, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot([LABEL], columns, "column", "value")
    ranks = long.join(wanted, [LABEL, "column"]).groupBy(LABEL, "column", "p", "n_values").agg(
        F.count_if(F.col("value") < F.col("estimate")).alias("below"), F.count_if(F.col("value") <= F.col("estimate")).alias("upto"))
    slack = SKETCH_RANK_ERROR * F.col("n_values") + 1
    inside = (F.col("below") - slack <= F.col("p") * F.col("n_values")) & (F.col("upto") + slack >= F.col("p") * F.col("n_values"))
    return ranks.select(outcome_name(F.col(LABEL)).alias("outcome"), "column", "p", "n_values", inside.alias("within_bound"))


def publish_guard(tables: dict[str, DataFrame], ids: DataFrame, id_columns: Sequence[str] = (ALERT_ID,),
                  max_rows: int = 5000) -> DataFrame:
    """Published tables hold no raw ids and fewer than ``max_rows`` rows.

    Ids must appear neither as a column nor as a value of a text column
    (``ids`` has one column of them); whole tables are searched for them.
    ``rows_seen`` stops at ``max_rows + 1``: more is not counted."""
    spark = ids.sparkSession
    known = ids.select(F.col(ids.columns[0]).cast("string").alias("_id"))
    rows = []
    for name, df in tables.items():
        n = df.limit(max_rows + 1).count()
        texts = [c for c, kind in df.dtypes if kind == "string"]
        cells = df.select(F.explode(F.array(*texts)).alias("_id")).distinct() if texts else None
        leaks = cells is not None and not cells.join(known, "_id", "left_semi").isEmpty()
        rows.append((name, int(n), n < max_rows, not any(c in df.columns for c in id_columns), not leaks))
    return spark.createDataFrame(rows, "table string, rows_seen long, small boolean, no_raw_ids boolean, no_id_values boolean")
