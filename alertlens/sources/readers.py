"""Readers for alerts and transactions in the reference's file layout.

Explicit schemas, no inference; categories stay strings; timestamps are
``TIMESTAMP_NTZ``.  Bad numbers or timestamps raise (ANSI casts), NaN amounts
become NULL once at ingest.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..schema import ALERT_DATE, ALERT_ID, AMOUNT, DIRECTION, LABEL, TX_TS, TX_TYPE
from .audit import CorruptParquetError, audit_parquet

# Our column -> column name in the raw files (defaults; pass your own mapping).
RAW_ALERT_COLUMNS = {ALERT_ID: "id", ALERT_DATE: "date", LABEL: "label"}
RAW_TX_COLUMNS = {ALERT_ID: "id", TX_TS: "ts", DIRECTION: "direction", TX_TYPE: "type", AMOUNT: "amount"}


def read_alerts(spark: SparkSession, path: str, columns: dict[str, str] | None = None,
                fmt: str = "csv") -> DataFrame:
    """Alerts with the date parsed to a midnight ``TIMESTAMP_NTZ``; label optional."""
    cols = columns or RAW_ALERT_COLUMNS
    reader = spark.read.option("header", True)
    raw = reader.csv(path, inferSchema=False) if fmt == "csv" else spark.read.format(fmt).load(path)
    out = [F.col(cols[ALERT_ID]).cast("string").alias(ALERT_ID),
           F.to_timestamp_ntz(F.col(cols[ALERT_DATE]).cast("string")).alias(ALERT_DATE)]
    if cols.get(LABEL) in raw.columns:
        out.append(F.col(cols[LABEL]).cast("int").alias(LABEL))
    return raw.select(*out)


def read_transactions(spark: SparkSession, path: str, columns: dict[str, str] | None = None,
                      audit_on_error: bool = True) -> DataFrame:
    """Five projected columns with typed casts; a corrupt file raises
    ``CorruptParquetError`` naming the file and the damage (S2 + S3)."""
    cols = columns or RAW_TX_COLUMNS
    try:
        raw = spark.read.parquet(path)
        df = raw.select(
            F.col(cols[ALERT_ID]).cast("string").alias(ALERT_ID),
            F.col(cols[TX_TS]).cast("timestamp_ntz").alias(TX_TS),
            F.col(cols[DIRECTION]).cast("string").alias(DIRECTION),
            F.col(cols[TX_TYPE]).cast("string").alias(TX_TYPE),
            nan_to_null(F.col(cols[AMOUNT]).cast("double")).alias(AMOUNT))
        df.limit(1).collect()          # touch the footer(s) now, not deep inside a job
        return df
    except CorruptParquetError:
        raise
    except Exception as exc:
        if audit_on_error:
            bad = audit_parquet(spark, path).where(~F.col("readable")).collect()
            if bad:
                b = bad[0]
                raise CorruptParquetError(
                    f"{b['path']} could not be read: {exc.__class__.__name__}. It has "
                    f"{b['replacement_chars']} U+FFFD replacement sequences: the copy was mangled by a "
                    f"text-mode transfer (bytes above 0x7F replaced) and cannot be repaired. "
                    f"Transfer it again in binary mode.") from exc
        raise


def read_expected_ids(spark: SparkSession, path: str, id_column: str = "id") -> DataFrame:
    """Ids of a sample file with their 1-based file position.

    Files count in path order and lines in file order.  Spark packs file
    splits into partitions by size, so the position is taken from the split
    itself (path, first byte) and the line order inside it: counts per split
    -> prefix offsets (a table of one row per split)."""
    from pyspark.sql import Window
    raw = spark.read.option("header", True).csv(path).select(
        F.col(id_column).cast("string").alias(ALERT_ID), F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"))
    tagged = raw.withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    split = ["_f", "_b"]
    counts = tagged.groupBy(*split).agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    offs = counts.select(*split, "_m0", F.coalesce(F.sum("_c").over(
        Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (tagged.join(offs, split)
            .select((F.col("_mid") - F.col("_m0") + F.col("_off") + 1).alias("ordinal"), ALERT_ID))
