"""Parquet file audit: which files are unreadable, and why (S3).

One row per file: path, length, PAR1 magic at head and tail, whether the
footer metadata parses, and the number of UTF-8 replacement sequences
(EF BF BD) -- the trace of a text-mode transfer that replaced every byte above
0x7F.  Files are listed by the ``binaryFile`` source and checked in
Arrow-batched tasks.  Files up to ``WHOLE_BYTES`` arrive with their content;
larger ones are opened by the task, which seeks to the magic and the footer.
Only files whose footer does not parse are read through, in ranges of
``RANGE_BYTES`` that are tasks of their own.
"""
from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MAGIC = b"PAR1"
REPLACEMENT = b"\xef\xbf\xbd"


class CorruptParquetError(RuntimeError):
    """A transaction file is damaged; the message names the file and the damage."""


#: files up to this size are read by the listing source
WHOLE_BYTES = 1 << 20
#: bytes of a damaged file that one task reads through, and at once
RANGE_BYTES = 256 << 20
PIECE = 16 << 20


def _readable(source) -> bool:
    import pyarrow.parquet as pq
    try:
        pq.read_metadata(source)
        return True
    except Exception:
        return False


def _count_replacements(stream, start: int = 0, stop: int | None = None) -> int:
    """Replacement sequences of a stream that begin in [start, stop), read in pieces that overlap by two bytes."""
    stream.seek(start)
    found, kept, left = 0, b"", None if stop is None else stop - start + 2
    while piece := stream.read(PIECE if left is None else min(PIECE, left)):
        found += (kept + piece).count(REPLACEMENT)
        kept = (kept + piece)[-2:]
        left = None if left is None else left - len(piece)
    return found


def _inspect_stream(stream, length: int) -> tuple[bool, bool, bool]:
    """(head magic, tail magic, footer parses) of a seekable file; nothing else of it is read."""
    head = stream.read(4) == MAGIC
    stream.seek(max(0, length - 4))
    tail = stream.read(4) == MAGIC
    stream.seek(0)
    return head, tail, head and tail and _readable(stream)


def _open(path: str):
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _can_open(path: str) -> bool:
    """Whether tasks can open files of this file system themselves."""
    from pyarrow import fs
    try:
        fs.FileSystem.from_uri(path)
        return True
    except Exception:
        return False


def _inspect(batches):
    for pdf in batches:
        rows = []
        for path, length, content in zip(pdf["path"], pdf["length"], pdf["content"]):
            if content is None:
                with _open(path) as stream:
                    found = _inspect_stream(stream, length)
                rows.append((*found, 0 if found[2] else None))
            else:
                stream = io.BytesIO(bytes(content))
                found = _inspect_stream(stream, length)
                rows.append((*found, 0 if found[2] else _count_replacements(stream)))
        out = pd.DataFrame(rows, columns=["head_magic", "tail_magic", "readable", "replacement_chars"])
        out["replacement_chars"] = out["replacement_chars"].astype("Int64")
        yield pd.concat([pdf[["path", "length"]].reset_index(drop=True), out], axis=1)


def _read_ranges(batches):
    for pdf in batches:
        found = []
        for path, start, stop in zip(pdf["path"], pdf["start"], pdf["stop"]):
            with _open(path) as stream:
                found.append(_count_replacements(stream, start, stop))
        yield pd.DataFrame({"path": pdf["path"], "found": found})


def audit_parquet(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, length, head_magic, tail_magic, readable, replacement_chars``."""
    ensure_checkpoint_dir(spark)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path))
    one = files.select("path").first()
    if one is not None and not _can_open(one["path"]):
        whole_bytes = max(whole_bytes, (1 << 31) - 1)          # only Spark can read it: a row holds the file
    small = files.where(F.col("length") <= whole_bytes).select("path", "length", "content")
    large = files.where(F.col("length") > whole_bytes).select("path", "length", F.lit(None).cast("binary").alias("content"))
    seen = small.unionByName(large).mapInPandas(
        _inspect, "path string, length long, head_magic boolean, tail_magic boolean, "
                  "readable boolean, replacement_chars long").checkpoint()
    ranges = (seen.where(F.col("replacement_chars").isNull())
              .select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length"), F.lit(range_bytes).cast("long"))).alias("start"))
              .select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("stop")))
    counted = (ranges.repartition(4 * spark.sparkContext.defaultParallelism, "path", "start")
               .mapInPandas(_read_ranges, "path string, found long").groupBy("path").agg(F.sum("found").alias("_found")))
    return (seen.join(counted, "path", "left")
            .withColumn("replacement_chars", F.coalesce("replacement_chars", "_found")).drop("_found"))
