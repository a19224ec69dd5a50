"""Run artifacts: run log, selection, summary, with the stale-artifact guard.

Each row of the run log carries an id made from its content and is written to
files of its own, named by that id: an append that is tried again replaces
itself, and two writers never touch the same file.  ``read_log`` keeps one row
an id; ``compact_log`` writes those to one folder.

Small metadata only (scalars, column lists, metric rows); written as JSON or
appended as one-row tables under a folder the caller chooses (a shared
folder on a cluster).
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: one row of the run log
LOG_SCHEMA = ("timestamp string, families string, n_columns int, model string, "
              "params string, cv_mean double, cv_std double, score double")
_NAMES = tuple(field.split()[0] for field in LOG_SCHEMA.split(", "))
_STORED = LOG_SCHEMA + ", run_id string"


def log_run(spark: SparkSession, path: str, **run) -> DataFrame:
    """Append one evaluation to the run log and return its row.

    Takes ``mean``, ``std``, ``families``, ``n_columns``, ``model`` and
    ``params``; the row adds the UTC time and the score (mean - std).  An
    optional ``key`` tells equal evaluations of different runs apart."""
    return log_runs(spark, path, [run])


def _run_id(row: dict, key: str) -> str:
    content = json.dumps([key, *(row[name] for name in _NAMES if name != "timestamp")])
    return hashlib.sha256(content.encode()).hexdigest()[:32]


def log_runs(spark: SparkSession, path: str, runs: Sequence[dict]) -> DataFrame:
    """Append several evaluations (the candidates of a search) in one write."""
    now = datetime.now(timezone.utc).replace(microsecond=0).isoformat()

    def values(run: dict) -> dict:
        figures = {"cv_mean": run["mean"], "cv_std": run["std"], "score": run["mean"] - run["std"]}
        row = {**{name: round(value, 6) for name, value in figures.items()},
               "timestamp": now, "model": run["model"], "n_columns": int(run["n_columns"]),
               "families": "|".join(run["families"]),
               "params": json.dumps(run["params"], sort_keys=True, default=str)}
        return {**row, "run_id": _run_id(row, run.get("key", ""))}

    rows = sorted((tuple(row[name] for name in (*_NAMES, "run_id")) for row in map(values, runs)), key=lambda r: r[-1])
    df = spark.createDataFrame(rows, _STORED)
    name = hashlib.sha256("".join(r[-1] for r in rows).encode()).hexdigest()[:32]
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}/run-{name}")
    return df.drop("run_id")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The run log, each evaluation once, with the time it was first written."""
    return _stored_log(spark, path).select(*_NAMES)


def _stored_log(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.schema(_STORED).option("header", True).option("recursiveFileLookup", True).csv(path)
    row = F.struct("timestamp", *(name for name in _NAMES if name != "timestamp"))
    return read.groupBy("run_id").agg(F.min(row).alias("row")).select("row.*", "run_id")


def compact_log(spark: SparkSession, path: str) -> None:
    """One folder instead of one for each append; appends made meanwhile stay as they are."""
    fs, p = _fs(spark, path)
    old = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("run-")]
    if len(old) < 2:
        return
    rows = _stored_log(spark, path).select(*_NAMES, "run_id").checkpoint()
    rows.coalesce(1).write.option("header", True).csv(f"{path.rstrip('/')}/run-{uuid4().hex}")
    for folder in old:                                   # a reader in between sees rows twice and keeps one
        fs.delete(folder, True)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_json(spark: SparkSession, path: str, obj) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(obj, indent=2, default=float).encode("utf-8")))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str):
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return json.loads(text)


def save_selection(spark: SparkSession, path: str, columns: Sequence[str], families: Sequence[str]) -> None:
    write_json(spark, path, {"columns": list(columns), "families": list(families)})


def load_selection(spark: SparkSession, path: str) -> dict:
    return read_json(spark, path)


def check_not_stale(selection: dict, summary: dict, found: dict | None = None) -> None:
    """Refuse a selection and a summary from different runs (column counts differ), and, given the fingerprint
    ``found`` of the feature table, a summary made from other data of the same width."""
    if len(selection["columns"]) != summary["n_columns"]:
        raise ValueError(
            f"selection and summary disagree: {len(selection['columns'])} columns vs "
            f"{summary['n_columns']} recorded; the artifacts are stale, run again")
    recorded = summary.get("fingerprint")
    if found is not None and recorded is not None and found != recorded:
        raise ValueError(f"the feature table has changed since the run: {found} vs {recorded} recorded; run again")
