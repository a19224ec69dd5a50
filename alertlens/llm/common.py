"""Shared helpers of the training-data operators.

A *word* is a maximal run of characters other than the space and U+0009-U+000D.
"""
from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.session import ensure_checkpoint_dir

WORD = r"[^ \x09-\x0D]+"
GAP = r"[ \x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def crc_table() -> list[int]:
    """Remainders of the 256 bytes by the CRC-32 polynomial, lowest bit first."""
    out = list(range(256))
    for _ in range(8):
        out = [(x >> 1) ^ (0xEDB88320 if x & 1 else 0) for x in out]
    return out


#: crc32 of a DuckDB blob expression, as BIGINT, folded byte by byte; for the oracles
SQL_CRC32 = (
    "xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(octet_length({0})), "
    "lambda i: CAST('0x' || substr(hex({0}), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)), "
    f"lambda c, x: xor(c >> 8, CAST({crc_table()}[(xor(c, x) & 255) + 1] AS BIGINT))), "
    "CAST(4294967295 AS BIGINT))")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, every other character untouched."""
    return F.translate(text, UPPER, UPPER.lower())


def id_hash(doc_id: Column) -> Column:
    """Pseudo-random but reproducible order key of a row id (hex md5)."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))


def hex_bucket(hex_key: Column, digits: int) -> Column:
    """The first hex digits of a key as an integer bucket in key order."""
    return F.conv(F.substring(hex_key, 1, digits), 16, 10).cast("int")


def checkpointed(df: DataFrame) -> DataFrame:
    """df.checkpoint() in the session's shared checkpoint folder, for small frames."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def materialize(df: DataFrame) -> DataFrame:
    """Write df once as a table in the session's shared checkpoint folder and read it back.

    Cuts the lineage like checkpoint(), computes the rows only once and keeps
    them compressed.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def renamed(docs: DataFrame, *needed: str) -> tuple[DataFrame, dict[str, str]]:
    """The rows under generated names, beside the columns needed under their own, and {column: generated name}.

    Joins may then add columns of any name without a clash; `restored` undoes it."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], *[F.col(c) for c in needed]), names


def restored(names: dict[str, str], **replaced: Column) -> list[Column]:
    """The columns under their own names again, some with new values."""
    return [replaced.get(c, F.col(n)).alias(c) for c, n in names.items()]
