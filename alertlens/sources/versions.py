"""Results published by one atomic step (S4), and fingerprints of frames.

A result is written to a folder of its own below ``<path>/versions`` and never
touched again.  ``<path>/CURRENT`` names the valid one.  Only that file is ever
replaced, by one rename over the old one (one object, on an object store), so a
reader sees the whole old or the whole new result wherever a writer stops.
"""
from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def new_version(path: str) -> str:
    """A folder for a result to be; it counts for nothing until ``point_to`` names it."""
    return f"{path.rstrip('/')}/versions/{uuid4().hex}"


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make the written folder ``version`` the current result of ``path``."""
    jvm = spark._jvm
    draft, target = (f"{path.rstrip('/')}/{name}" for name in (f".{POINTER}-{uuid4().hex}", POINTER))
    out = _fs(spark, path).create(_path(spark, draft), True)
    try:
        out.write(bytearray(version.rsplit("/", 1)[1].encode()))
    finally:
        out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, draft).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(_path(spark, draft)), context.makeQualified(_path(spark, target)), over)


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the current result, None before the first."""
    pointer = f"{path.rstrip('/')}/{POINTER}"
    if not _fs(spark, path).exists(_path(spark, pointer)):
        return None
    (row,) = spark.read.text(pointer, wholetext=True).collect()
    return f"{path.rstrip('/')}/versions/{row.value.strip()}"


def drop_old(spark: SparkSession, path: str) -> int:
    """Delete all versions but the current one; returns how many.  Not while someone writes."""
    keep, fs = current(spark, path), _fs(spark, path)
    folder = _path(spark, f"{path.rstrip('/')}/versions")
    if keep is None or not fs.exists(folder):
        return 0
    old = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() != keep.rsplit("/", 1)[1]]
    for p in old:
        fs.delete(p, True)
    return len(old)


def fingerprint(df: DataFrame, digits: int = 6) -> dict[str, str]:
    """Rows, sum and xor of the row hashes: equal for equal rows in any order and partitioning.

    Fractional columns are rounded first, as sums may differ in their last bits."""
    cols = [F.round(F.col(f"`{name}`").cast("double"), digits) if kind in ("double", "float") else F.col(f"`{name}`")
            for name, kind in df.dtypes]
    row = df.select(F.xxhash64(*cols).alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("sum"), F.bit_xor("h").alias("xor")).first()
    return {"rows": str(row["rows"]), "sum": str(row["sum"] or 0), "xor": str(row["xor"] or 0)}
