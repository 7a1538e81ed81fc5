"""Results of resumable runs: rows first, then the record that makes them count.

A run writes its rows to ``rows/run=<id>`` and, when these are complete, the units it has done with
their status to ``manifest/run=<id>``. Only runs whose manifest is complete exist for readers. A job
that is killed before that leaves rows nobody sees, its units are still pending, and the next run
does them again: every unit's rows are there once, however often a job is stopped or repeated.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DONE = "_SUCCESS"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _runs(spark: SparkSession, path: str, part: str, complete: bool) -> list[str]:
    folder, fs = _folder(spark, f"{path}/{part}")
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory()]
    names = [p.getName() for p in found if not complete or fs.exists(_folder(spark, f"{p.toString()}/{_DONE}")[0])]
    return sorted(n.removeprefix("run=") for n in names)


def committed(spark: SparkSession, path: str) -> list[str]:
    """Ids of the runs that count."""
    return _runs(spark, path, "manifest", complete=True)


def _read(spark: SparkSession, path: str, part: str) -> DataFrame | None:
    folders = [f"{path}/{part}/run={r}" for r in committed(spark, path)]
    return spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None


def finished(spark: SparkSession, path: str) -> DataFrame | None:
    """Units done by runs that count, with their status; none before the first."""
    return _read(spark, path, "manifest")


def results(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of the runs that count; none before the first."""
    return _read(spark, path, "rows")


def pending(spark: SparkSession, path: str, units: DataFrame, on: list[str]) -> DataFrame:
    """Units that no run that counts has done."""
    done = finished(spark, path)
    return units if done is None else units.join(done.select(*on).distinct(), on, "left_anti")


def resume(spark: SparkSession, path: str, units: DataFrame, on: list[str], work: Callable[[DataFrame], DataFrame]) -> int:
    """Do the pending units; the number of rows written.

    ``units`` may have many rows a unit, named by the columns ``on``; ``work`` makes rows that keep
    these columns. A unit's status is ok, or empty where it gives no rows.
    """
    run = uuid.uuid4().hex
    todo = pending(spark, path, units, on)
    work(todo).write.parquet(f"{path}/rows/run={run}")
    rows = spark.read.parquet(f"{path}/rows/run={run}")
    has_rows = rows.select(*on).distinct().withColumn("_rows", F.lit(True))
    keys = todo.select(*on).distinct()
    same = [keys[c].eqNullSafe(has_rows[c]) for c in on]
    status = F.when(F.col("_rows"), "ok").otherwise("empty").cast(T.StringType()).alias("status")
    keys.join(has_rows, same, "left").select(*[keys[c] for c in on], status).write.parquet(f"{path}/manifest/run={run}")
    return rows.count()


def sweep(spark: SparkSession, path: str) -> int:
    """Delete what stopped runs left; how many there were. Not while a run is at work."""
    good = set(committed(spark, path))
    gone = 0
    for part in ("rows", "manifest"):
        for run in _runs(spark, path, part, complete=False):
            if run not in good:
                folder, fs = _folder(spark, f"{path}/{part}/run={run}")
                fs.delete(folder, True)
                gone += part == "rows"
    return gone
