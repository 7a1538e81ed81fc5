"""Readers, writers and whole jobs on files in a scratch folder."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from codequarry import session
from codequarry.operators import curate, leakage
from codequarry.plans import jobs
from codequarry.sources import readers, sinks

CODE = "// adds\nfunction add(a: number) { return a }\n"


def test_raw_source_formats(spark, tmp_path):
    spark.createDataFrame([("p1", CODE), ("p1", CODE)], "max_stars_repo_path string, content string").write.parquet(f"{tmp_path}/pq")
    (tmp_path / "js").mkdir()
    with gzip.open(tmp_path / "js" / "a.json.gz", "wt") as f:
        f.write("".join(json.dumps({"path": f"p{i}", "content": CODE}) + "\n" for i in range(3)))
    (tmp_path / "raw.jsonl").write_text(json.dumps({"file_name": "f.ets", "raw_text": CODE}) + "\n")
    for df, n in (
        (readers.source_parquet(spark, f"{tmp_path}/pq"), 2),
        (readers.source_json(spark, f"{tmp_path}/js"), 3),
        (readers.source_json(spark, f"{tmp_path}/js", partitions=4), 3),
        (readers.source_jsonl(spark, f"{tmp_path}/raw.jsonl"), 1),
    ):
        rows = df.collect()
        assert df.columns == ["file_id", "path", "content"]
        assert len({r.file_id for r in rows}) == n and {r.content for r in rows} == {CODE}


def test_source_tree(spark, tmp_path):
    (tmp_path / "o" / "r").mkdir(parents=True)
    (tmp_path / "o" / "r" / "a.ets").write_text(CODE + "// 中文")
    (tmp_path / "o" / "r" / "bad.ets").write_bytes(b"\xff\xfe function")
    (tmp_path / "o" / "r" / "other.ts").write_text(CODE)
    rows = readers.source_tree(spark, str(tmp_path)).collect()
    found = {r.path: r.content for r in rows}
    assert found == {f"{tmp_path}/o/r/a.ets": CODE + "// 中文", f"{tmp_path}/o/r/bad.ets": None}


def test_tolerant_jsonl(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"a": "x", "n": 1}\n\n{broken\n   \n{"a": "é", "n": null}\n"text"\n{"n": 3}\n')
    df = readers.tolerant_jsonl(spark, f"{tmp_path}/in.jsonl", "a string, n int")
    assert [(r.a, r.n) for r in df.orderBy(*readers.LINE_ORDER).collect()] == [("x", 1), ("é", None), (None, 3)]


def test_line_order_over_many_splits(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text("".join(json.dumps({"n": i, "pad": "x" * 200}) + "\n" for i in range(2000)))
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        df = readers.tolerant_jsonl(spark, f"{tmp_path}/in.jsonl", "n int")
        assert df.rdd.getNumPartitions() > 4
        assert [r.n for r in df.orderBy(*readers.LINE_ORDER).collect()] == list(range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_lists(spark, tmp_path):
    (tmp_path / "enry.json").write_text(json.dumps({"TypeScript": ["a.ets", "b/c.ets"], "JSON": ["d.json"]}))
    rows = readers.classified_files(spark, f"{tmp_path}/enry.json", "TypeScript").collect()
    assert sorted(r.path for r in rows) == [f"{tmp_path}/a.ets", f"{tmp_path}/b/c.ets"]
    assert readers.classified_files(spark, f"{tmp_path}/enry.json", "Go").count() == 0
    (tmp_path / "repos.csv").write_text("full_name,url\na/b, https://x/a/b \nc/d,\ne/f,https://x/a/b\n")
    urls = readers.repo_urls(readers.repo_list_csv(spark, f"{tmp_path}/repos.csv"))
    assert [r.url for r in urls.collect()] == ["https://x/a/b"]
    repos = spark.createDataFrame([("a/b", 3, "TypeScript"), ('q"x', 0, None)], "full_name string, stars int, language string")
    sinks.write_csv(repos, f"{tmp_path}/csv")
    back = readers.repo_list_csv(spark, f"{tmp_path}/csv").collect()
    assert back[0].asDict().keys() == {"full_name", "stars", "language"} and len(back) == 2


def test_jsonl_sink(spark, tmp_path):
    df = spark.createDataFrame([("é\n", None, ["x", None])], "a string, b int, c array<string>")
    sinks.write_jsonl(df.coalesce(1), f"{tmp_path}/out")
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == '{"a":"é\\n","b":null,"c":["x",null]}\n'
    assert json.loads(df.select(sinks.json_line("a", "b", "c")).first()[0]) == {"a": "é\n", "b": None, "c": ["x", None]}


def test_splits_reader(spark, tmp_path):
    for s in ("train", "test"):
        spark.createDataFrame([(s, 1)], "nwo string, n int").write.parquet(f"{tmp_path}/{s}")
    df = readers.splits(spark, str(tmp_path), list(leakage.SPLITS))
    assert sorted((r.split, r.nwo) for r in df.collect()) == [("test", "test"), ("train", "train")]


def test_license_records_keep_their_order(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text("".join(
        json.dumps({"source": "g", "repo": "a/b", "license": x, "allowed": True}) + "\n" for x in ("MIT", "ISC", "GPL-3.0", "0BSD")
    ))
    table = curate.license_map(readers.license_records(spark, f"{tmp_path}/l.jsonl"))
    assert [(r.source, r.repo, r.license) for r in table.collect()] == [("g", "a/b", "0BSD")]


def test_extraction_to_deduplication(spark, tmp_path):
    for repo in ("o/r1", "o/r2", "o/skip"):
        (tmp_path / "repos" / repo / "src").mkdir(parents=True)
        (tmp_path / "repos" / repo / "src" / "a.ets").write_text(CODE)
    shas = spark.createDataFrame([("o/r1", "c1"), ("o/r2", "c2")], "nwo string, sha string")
    done = spark.createDataFrame([("o/skip",)], "nwo string")
    assert jobs.scan_repositories(spark, f"{tmp_path}/repos", f"{tmp_path}/functions", shas, done) == 2
    rows = spark.read.parquet(f"{tmp_path}/functions")
    assert {f.split()[0] for f in readers.FUNCTION_SCHEMA.split(", ")} == set(rows.columns)
    assert sorted((r.nwo, r.sha, r.path, r.identifier) for r in rows.collect()) == [
        ("o/r1", "c1", "src/a.ets", "add"), ("o/r2", "c2", "src/a.ets", "add")
    ]
    info = spark.createDataFrame([("o/r2", False, 0, 9, 1, ["t"])], readers.REPO_INFO_SCHEMA)
    info.write.parquet(f"{tmp_path}/info")
    assert jobs.deduplicate(spark, f"{tmp_path}/functions", f"{tmp_path}/info", f"{tmp_path}/out") == 1
    (best,) = spark.read.parquet(f"{tmp_path}/out/functions").collect()
    assert (best.nwo, best.duplicate_count, len(best.function_sha), best.docstring) == ("o/r2", 2, 32, "adds")
    (dup,) = spark.read.parquet(f"{tmp_path}/out/duplicates").collect()
    assert len(dup.duplicates) == 2
    assert next((tmp_path / "out" / "functions").glob("*.parquet")).name.endswith(".gz.parquet")
    jobs.parquet_to_jsonl(spark, f"{tmp_path}/out/functions", f"{tmp_path}/jsonl")
    jobs.merge(spark, [f"{tmp_path}/jsonl", f"{tmp_path}/jsonl"], f"{tmp_path}/merged", ["github", "gitee"])
    merged = spark.read.json(f"{tmp_path}/merged").collect()
    assert [r.source for r in merged] == ["github"]
    jobs.filter_docstring(spark, f"{tmp_path}/merged", f"{tmp_path}/with-docs")
    (tmp_path / "licenses.jsonl").write_text('{"source": "github", "repo": "o/r2", "license": "MIT", "allowed": true}\n')
    jobs.filter_license(spark, f"{tmp_path}/with-docs", f"{tmp_path}/licenses.jsonl", f"{tmp_path}/final")
    assert spark.read.json(f"{tmp_path}/final").count() == 1


def test_extract_path(spark, tmp_path):
    for folder in ("test", "src"):
        (tmp_path / "repo" / folder).mkdir(parents=True)
        (tmp_path / "repo" / folder / "a.ets").write_text(CODE)
    assert jobs.extract_path(spark, f"{tmp_path}/repo", f"{tmp_path}/out.json", "o/r", "c1") == 1
    (row,) = spark.read.json(f"{tmp_path}/out.json").collect()
    assert (row.path, row.language, row.url) == ("src/a.ets", "arkts", "https://github.com/o/r/blob/c1/src/a.ets#L2-L2")
    assert jobs.extract_path(spark, f"{tmp_path}/repo/src/a.ets", f"{tmp_path}/single") == 1
    (row,) = spark.read.parquet(f"{tmp_path}/single").collect()
    assert (row.path, row.nwo, row.identifier) == ("", "", "add")


def test_scan_takes_classified_files_only(spark, tmp_path):
    (tmp_path / "repos" / "o" / "r").mkdir(parents=True)
    for name in ("a", "b"):
        (tmp_path / "repos" / "o" / "r" / f"{name}.ets").write_text(CODE)
    (tmp_path / "repos" / "o" / "r" / "languages.json").write_text('{"arkts": ["b.ets"], "other": ["a.ets"]}')
    listed = readers.classified_files(spark, f"{tmp_path}/repos/o/r/languages.json", "arkts")
    jobs.scan_repositories(spark, f"{tmp_path}/repos", f"{tmp_path}/out", classified=listed)
    assert [r.path for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["b.ets"]


@pytest.mark.parametrize("job, folder", [(jobs.extract_parquet, "pq"), (jobs.extract_json, "js"), (jobs.extract_jsonl, "raw")])
def test_bulk_jobs(spark, tmp_path, job, folder):
    spark.createDataFrame([("p1", CODE), ("p2", " " * 40000 + CODE)], "max_stars_repo_path string, content string").write.parquet(f"{tmp_path}/pq")
    spark.createDataFrame([("p1", CODE), ("p2", " " * 40000 + CODE)], "path string, content string").write.json(f"{tmp_path}/js")
    spark.createDataFrame([("p1", CODE)], "file_name string, raw_text string").write.json(f"{tmp_path}/raw")
    job(spark, f"{tmp_path}/{folder}", f"{tmp_path}/out")
    # The JSON job's limit is 32 KiB, so its second file gives nothing but a status.
    rows = spark.read.parquet(f"{tmp_path}/out")
    assert rows.count() == (2 if folder == "pq" else 1)
    assert {r.language for r in rows.collect()} == {"arkts"}
    if folder != "raw":
        assert {(r.type, r.start_point.row) for r in rows.collect()} == {("function", 1)}
        status = sorted(r.status for r in spark.read.parquet(f"{tmp_path}/out_status").collect())
        assert status == (["ok", "ok"] if folder == "pq" else ["ok", "too_large"])


def test_large_files_keep_their_functions(spark, tmp_path):
    big = CODE + "// filler\n" * 500_000
    spark.createDataFrame([("big", big)], "file_name string, raw_text string").write.json(f"{tmp_path}/raw")
    assert len(big) > 5_000_000 and jobs.extract_jsonl(spark, f"{tmp_path}/raw", f"{tmp_path}/out") == 1


def test_undecodable_files_have_a_status(spark, tmp_path):
    (tmp_path / "repos" / "o" / "r").mkdir(parents=True)
    (tmp_path / "repos" / "o" / "r" / "a.ets").write_text(CODE)
    (tmp_path / "repos" / "o" / "r" / "b.ets").write_bytes(b"\xff\xfe function f() { }")
    assert jobs.scan_repositories(spark, f"{tmp_path}/repos", f"{tmp_path}/out") == 1
    status = {r.file_id[-5:]: r.status for r in spark.read.parquet(f"{tmp_path}/out_status").collect()}
    assert status == {"a.ets": "ok", "b.ets": "undecodable"}


@pytest.mark.parametrize("name", ["o/r.git", "o##r", "o/r"])
def test_license_names_are_canonical(spark, name):
    records = spark.createDataFrame([("gitee", name, "MIT", 1)], "source string, repo string, license string, line_no int")
    rows = spark.createDataFrame([(1, "gitee", "o/r"), (2, "gitee", "o/other"), (3, None, None)], "id int, source string, nwo string")
    assert [r.id for r in curate.filter_license(rows, curate.license_map(records)).collect()] == [1]


def test_reports(spark):
    df = spark.range(200).selectExpr(
        "id", "if(id % 4 = 0, 'test', 'train') as split", "concat('o/r', id % 9) as nwo", "concat('says thing number ', id % 50) as docstring",
        "concat('function f', id % 60, ' ( a ) { return a }') as function", "cast(id % 60 as string) as function_sha",
        "'a#b' as ast_function", "'f' as identifier", "'s' as source",
    )
    report = jobs.audit(df)
    assert report["near_duplicates"].count() == 4 and report["exact_duplicates"].count() == 3
    assert all(t.count() > 0 for t in jobs.describe(df).values())


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == folder
    df = session.written(spark.range(5), "numbers")
    assert df.count() == 5 and folder in df.inputFiles()[0]
    assert df.where(F.col("id") > 10).count() == 0


def test_intermediates_leave_nothing_behind(spark, tmp_path):
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with session.intermediates(spark):
        df = session.written(spark.range(5), "numbers")
        df.write.parquet(f"{tmp_path}/result")
        assert len(set(os.listdir(folder)) - before) == 1
    assert set(os.listdir(folder)) == before
    assert spark.read.parquet(f"{tmp_path}/result").count() == 5


def test_records_keep_their_keys(spark, tmp_path):
    lines = [
        '{"docstring": "d", "function": "f", "extra": {"deep": [1, "ü"]}, "n": 1.5, "imports": ["x"], "source": "old"}',
        "", "broken {", "[1]", '{"function": "g", "docstring": null}', '{"function": "g"}', '{"function": "g", "docstring": ""}',
        '{"docstring": "d", "function": "f", "other": true}',
    ]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    assert readers.jsonl_records(spark, f"{tmp_path}/a.jsonl").count() == 5
    assert jobs.merge(spark, [f"{tmp_path}/a.jsonl"], f"{tmp_path}/merged", ["new"]) == 3
    got = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/merged").collect()]
    # An absent docstring counts as '', a null one does not.
    assert sorted(got, key=str) == sorted([
        {"docstring": "d", "function": "f", "extra": {"deep": [1, "ü"]}, "n": 1.5, "source": "new"},
        {"function": "g", "docstring": None, "source": "new"},
        {"function": "g", "source": "new"},
    ], key=str)
    assert jobs.filter_docstring(spark, f"{tmp_path}/a.jsonl", f"{tmp_path}/all", deduplicate=False) == 2
    assert jobs.filter_docstring(spark, f"{tmp_path}/a.jsonl", f"{tmp_path}/first") == 1
    (row,) = spark.read.text(f"{tmp_path}/first").collect()
    assert json.loads(row.value) == json.loads(lines[0])
    (tmp_path / "l.jsonl").write_text('{"source": "gitee", "repo": "o##r", "license": "MIT", "allowed": true}\n')
    (tmp_path / "b.jsonl").write_text('{"source": "gitee", "nwo": "o/r", "more": [null]}\n{"source": "gitee", "nwo": "o/q"}\n{}\n')
    assert jobs.filter_license(spark, f"{tmp_path}/b.jsonl", f"{tmp_path}/l.jsonl", f"{tmp_path}/licensed") == 1
    (row,) = spark.read.text(f"{tmp_path}/licensed").collect()
    assert json.loads(row.value) == {"source": "gitee", "nwo": "o/r", "more": [None]}
