"""Adapter from the driver's parquet tables to the alert model.

Alerts are customers (``customer``), transactions are events (``events``).
The mapping is deterministic SQL, so the oracle can state the same thing in
DuckDB (see ``alertlens.oracle``).  Every customer is an alert: customers
without events are "silent" alerts, which exercises the null contract.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..schema import ALERT_DATE, ALERT_ID, AMOUNT, DIRECTION, LABEL, SPLIT, TX_TS, TX_TYPE

# --- fixed values of the adapter -------------------------------------------
# event_type -> transaction type; anything else becomes "other" (outside the
# frozen type list, so it is counted in totals but has no type column).
EVENT_TYPE_TO_TX_TYPE = (("click", "card"), ("view", "bank"),
                         ("purchase", "cash"), ("signup", "intl"))
UNKNOWN_TX_TYPE = "other"
AMOUNT_CENTER, AMOUNT_SCALE = 50.0, 50.0
ALERT_BASE_DATE = "2024-01-15 00:00:00"
ALERT_DATE_SPREAD_DAYS = 16
LABEL_ACCTBAL_BELOW = 870.0
TEST_SPLIT_FROM = 7          # c_custkey % 10 >= 7 -> test
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``alert_id, tx_ts, direction, tx_type, amount`` from ``events``."""
    ev = table(spark, sf_dir, "events")
    tx_type = F.lit(UNKNOWN_TX_TYPE)
    for event_type, mapped in reversed(EVENT_TYPE_TO_TX_TYPE):
        tx_type = F.when(F.col("event_type") == event_type, F.lit(mapped)).otherwise(tx_type)
    return ev.select(
        F.col("user_id").alias(ALERT_ID),
        F.col("ts").cast("timestamp_ntz").alias(TX_TS),
        F.when(F.col("event_id") % 2 == 0, F.lit("in")).otherwise(F.lit("out")).alias(DIRECTION),
        tx_type.alias(TX_TYPE),
        nan_to_null((F.col("value") - AMOUNT_CENTER) / AMOUNT_SCALE).alias(AMOUNT),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``alert_id, alert_date, label, split`` from ``customer``."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias(ALERT_ID),
        F.timestamp_add("DAY", (F.col("c_custkey") % ALERT_DATE_SPREAD_DAYS).cast("int"),
                        F.lit(ALERT_BASE_DATE).cast("timestamp_ntz")).alias(ALERT_DATE),
        F.when(F.col("c_acctbal") < LABEL_ACCTBAL_BELOW, F.lit(1)).otherwise(F.lit(0)).alias(LABEL),
        F.when(F.col("c_custkey") % 10 >= TEST_SPLIT_FROM, F.lit("test"))
         .otherwise(F.lit("train")).alias(SPLIT),
    )


def split(alerts_df: DataFrame, name: str) -> DataFrame:
    return alerts_df.where(F.col(SPLIT) == name)
