"""Alert de-duplication and the prepared transaction history."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import days_between, flag, safe_div
from ..schema import (ALERT_DATE, ALERT_ID, DIRECTION, NIGHT_END, NIGHT_START,
                      OUT_DIRECTION, TX_TS, WEEKEND_FROM)


def dedup_alerts(alerts: DataFrame) -> DataFrame:
    """One row per alert id.  Spark has no file order, so "first" is the
    smallest remaining tuple (alert_date, label, ...): identical to the
    reference whenever duplicates are exact copies.  Partial aggregation keeps
    a heavily duplicated id from landing in one task unreduced."""
    rest = [c for c in alerts.columns if c != ALERT_ID]
    if not rest:
        return alerts.distinct()
    picked = alerts.groupBy(ALERT_ID).agg(F.min(F.struct(*rest)).alias("_first"))
    return picked.select(ALERT_ID, *[F.col(f"_first.{c}").alias(c) for c in rest])


def not_after_last_alert(tx: DataFrame, alerts: DataFrame) -> DataFrame:
    """Transactions up to the last alert date: no later one is before its alert.

    The date is a scalar subquery, so it is known before the scan starts and
    skips row groups and files there; Spark adds a Bloom filter of the alert ids
    itself where the join is shuffled and the transactions are large."""
    return tx.where(F.col(TX_TS) <= alerts.agg(F.max(ALERT_DATE)).scalar())


def prepare(tx: DataFrame, alerts: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Transactions joined to their (unique) alert, at or before the alert date.

    ``carry`` names further alert columns (the label) to bring along, so that
    no second join on the alert is needed.  Duplicate alerts are resolved on
    whole rows: date and carried columns come from the same one.

    Adds ``days_before`` (fractional days), ``out`` (1 when outgoing), ``hour``,
    ``dow`` (Monday=0), ``tx_date``, ``night`` and ``weekend``.  Rows of unknown
    alerts and rows after the alert timestamp are dropped.  The join is left to
    AQE: broadcast when the alert side is small, shuffled (with skew splitting
    of hot alerts) otherwise.
    """
    keyed = dedup_alerts(alerts).select(ALERT_ID, ALERT_DATE, *carry)
    joined = not_after_last_alert(tx, alerts).join(keyed, ALERT_ID, "inner")
    days = days_between(F.col(TX_TS), F.col(ALERT_DATE))
    hour = F.hour(TX_TS)
    return (joined.withColumn("days_before", days)
            .where(F.col("days_before") >= 0)
            .withColumn("out", (F.col(DIRECTION) == OUT_DIRECTION).cast("int"))
            .withColumn("out", F.coalesce(F.col("out"), F.lit(0)))
            .withColumn("hour", hour)
            .withColumn("dow", F.weekday(TX_TS))
            .withColumn("tx_date", F.to_date(TX_TS))
            .withColumn("night", flag((F.col("hour") < NIGHT_END) | (F.col("hour") >= NIGHT_START)))
            .withColumn("weekend", flag(F.col("dow") >= WEEKEND_FROM)))


def silent_alerts(alerts: DataFrame, history: DataFrame) -> DataFrame:
    """Alerts with no transaction left after preparation (anti join).

    The history is reduced to its ids first: rows on the right of an anti join
    cannot be split, so a hot alert must not reach it row by row."""
    return dedup_alerts(alerts).join(history.select(ALERT_ID).distinct(), ALERT_ID, "left_anti")


def prep_audit(tx: DataFrame, alerts: DataFrame) -> DataFrame:
    """Raw rows, kept rows, dropped rows and dropped share, in one pass."""
    keyed = dedup_alerts(alerts).select(ALERT_ID, ALERT_DATE)
    days = days_between(F.col(TX_TS), F.col(ALERT_DATE))
    j = tx.join(keyed, ALERT_ID, "left")
    agg = j.agg(F.count(F.lit(1)).alias("raw_rows"),
                F.count_if(days >= 0).alias("kept_rows"))
    return agg.select("raw_rows", "kept_rows",
                      (F.col("raw_rows") - F.col("kept_rows")).alias("dropped_rows"),
                      safe_div(F.col("raw_rows") - F.col("kept_rows"), F.col("raw_rows"))
                      .alias("dropped_share"))
