"""Runs that are stopped between their writes and run again."""

import pytest
from codequarry.sources import ledger
from pyspark.sql import functions as F


def units(spark, names):
    return spark.createDataFrame([(n, k) for n in names for k in range(3)], "nwo string, k int")


def work(todo):
    return todo.where("nwo <> 'none'").select("nwo", (F.col("k") * 10).alias("value"))


def rows(spark, path):
    found = ledger.results(spark, path)
    return sorted((r.nwo, r.value) for r in found.collect()) if found is not None else []


def test_a_run_killed_between_the_writes_counts_for_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    assert rows(spark, path) == [] and ledger.committed(spark, path) == []
    # The first job dies with its rows written and no manifest, the second while committing one.
    work(units(spark, ["a", "b"])).write.parquet(f"{path}/rows/run=dead")
    units(spark, ["a"]).write.parquet(f"{path}/manifest/run=half")
    (tmp_path / "out/manifest/run=half/_SUCCESS").unlink()
    work(units(spark, ["a"])).write.parquet(f"{path}/rows/run=half")
    assert rows(spark, path) == []
    assert ledger.resume(spark, path, units(spark, ["a", "b", "none"]), ["nwo"], work) == 6
    want = [(n, v) for n in "ab" for v in (0, 10, 20)]
    assert rows(spark, path) == want
    # Again: nothing is pending, nothing doubles; a new unit is done alone.
    assert ledger.resume(spark, path, units(spark, ["a", "b", "none"]), ["nwo"], work) == 0
    assert ledger.resume(spark, path, units(spark, ["b", "c"]), ["nwo"], work) == 3
    assert rows(spark, path) == want + [("c", v) for v in (0, 10, 20)]
    status = {r.nwo: r.status for r in ledger.finished(spark, path).collect()}
    assert status == {"a": "ok", "b": "ok", "c": "ok", "none": "empty"}
    assert ledger.sweep(spark, path) == 2 and len(ledger.committed(spark, path)) == 3
    assert rows(spark, path) == want + [("c", v) for v in (0, 10, 20)]


def test_work_that_fails_leaves_units_pending(spark, tmp_path):
    path = str(tmp_path / "out")
    broken = lambda todo: work(todo).withColumn("value", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        ledger.resume(spark, path, units(spark, ["a"]), ["nwo"], broken)
    assert ledger.pending(spark, path, units(spark, ["a"]), ["nwo"]).count() == 3 and rows(spark, path) == []
