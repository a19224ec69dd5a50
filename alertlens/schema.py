"""Column names, frozen categories and fixed parameters of the alert model."""
from __future__ import annotations

from pyspark.sql import types as T

# Column names used throughout the library.
ALERT_ID = "alert_id"
ALERT_DATE = "alert_date"
LABEL = "label"
SPLIT = "split"
TX_TS = "tx_ts"
DIRECTION = "direction"
TX_TYPE = "tx_type"
AMOUNT = "amount"
SCORE = "score"

# --- fixed values (must stay as they are for results to match) -------------
# Frozen category lists: output columns exist for these values only, in this
# order, whether or not they occur in the data.
DIRECTIONS = ("in", "out")
TX_TYPES = ("card", "bank", "cash", "intl")
# Outgoing direction value used by the flow/window families.
OUT_DIRECTION = "out"
# Look-back windows in days (inclusive upper bound).
WINDOWS = (3, 7, 14, 30, 60, 90, 120)
# Amount quantiles of the amount_shape family: column name -> probability.
AMOUNT_QUANTILES = (("amt_med", 0.5), ("amt_q10", 0.1), ("amt_q25", 0.25),
                    ("amt_q75", 0.75), ("amt_q90", 0.9), ("amt_q99", 0.99))
# Threshold of the "big amount" flag.
BIG_AMOUNT = 2.0
# Night hours are hour < 6 or hour >= 22; weekend is weekday (Mon=0) >= 5.
NIGHT_START, NIGHT_END, WEEKEND_FROM = 22, 6, 5
# Outcome names of the label codes.
OUTCOMES = ((0, "Dismissed"), (1, "Escalated"))
# Count-like column prefixes: 0 when nothing matched, never NULL.
COUNT_PREFIXES = ("base_cnt", "dir_n_", "ty_n_", "cross_n_", "win_n", "hour_active_days")
# ---------------------------------------------------------------------------

FAMILIES = ("base", "amount_shape", "direction_type", "cross", "flow",
            "windows", "burst", "hour", "signal_date")

ALERT_SCHEMA = T.StructType([
    T.StructField(ALERT_ID, T.StringType()),
    T.StructField(ALERT_DATE, T.StringType()),
    T.StructField(LABEL, T.IntegerType()),
])

TX_SCHEMA = T.StructType([
    T.StructField(ALERT_ID, T.StringType()),
    T.StructField(TX_TS, T.TimestampNTZType()),
    T.StructField(DIRECTION, T.StringType()),
    T.StructField(TX_TYPE, T.StringType()),
    T.StructField(AMOUNT, T.DoubleType()),
])


def is_count_column(name: str) -> bool:
    return name.startswith(COUNT_PREFIXES)
