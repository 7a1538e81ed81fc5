"""Deduplication, merging, licences, projections and joins on literal edge cases."""

import pytest
from pyspark.sql import functions as F

from codequarry.operators import curate, links, pages, project, skew

REPOS = "full_name string, fork boolean, forks int, stargazers_count int, watchers int, topics array<string>"


def test_best_functions(spark):
    rows = spark.createDataFrame(
        [
            ("h1", "u3", "p", 5), ("h1", "u2", "p", 5), ("h1", "u1", "p", None), ("h1", None, "p", 1),
            ("h2", "v1", "p", None), ("h2", "v2", "p", 0), (None, "n1", "p", 1), (None, "n2", "p", 9),
        ],
        "function_sha string, url string, path string, stargazers_count int",
    )
    got = {r.function_sha: (r.url, r.duplicate_count) for r in curate.best_functions(rows).collect()}
    assert got == {"h1": ("u2", 3), "h2": ("v2", 2), None: ("n2", 2)}
    pairs = {(r.function_sha, r.duplicate_url) for r in curate.duplicate_urls(rows).collect()}
    assert pairs == {("h1", "u1"), ("h1", "u2"), ("h1", "u3"), ("h2", "v1"), ("h2", "v2"), (None, "n1"), (None, "n2")}


def test_best_functions_is_thin(spark):
    rows = spark.createDataFrame(
        [("h", "u", "p", 1, "text"), ("h", "u", "p", 1, "text"), ("h", "v", "p", 2, "other")],
        "function_sha string, url string, path string, stargazers_count int, function string",
    )
    best = curate.best_functions(rows)
    assert [(r.url, r.function, r.duplicate_count) for r in best.collect()] == [("v", "other", 3)]
    alike = curate.best_functions(rows.where("url = 'u'"))
    assert [(r.url, r.duplicate_count) for r in alike.collect()] == [("u", 2)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.split("Initial Plan")[-1].splitlines() if "SortAggregate" in line]
    assert all("function#" not in line.replace("function_sha", "") for line in sorts)


def test_enrich_takes_one_row_per_repository(spark):
    functions = spark.createDataFrame(
        [("a/x", "s" * 40, "u1"), ("a/y", "t" * 40, "u2")], "nwo string, function_sha string, url string"
    )
    repos = spark.createDataFrame(
        [("a/x", False, 1, 3, 1, ["t1", "t2"]), ("a/x", False, 1, 8, 1, ["t3"]), ("a/x", False, 1, None, 1, ["t4"])], REPOS
    )
    got = {r.nwo: (r.stargazers_count, r.topics, r.function_sha) for r in curate.enrich(functions, repos).collect()}
    assert got == {"a/x": (8, "t3", "s" * 32), "a/y": (None, None, "t" * 32)}


def test_duplicate_lists_page_a_hot_hash(spark):
    hot = spark.range(5000).select(F.lit("hot").alias("function_sha"), F.format_string("u%05d", "id").alias("url"))
    cold = spark.range(50).select(F.concat(F.lit("c"), "id").alias("function_sha"), F.concat(F.lit("v"), "id").alias("url"))
    lists = curate.duplicate_lists(hot.unionAll(cold), page_size=100).cache()
    assert lists.agg(F.max(F.size("duplicates"))).first()[0] <= 100
    pages = lists.where("function_sha = 'hot'").orderBy("page").collect()
    assert [(r.page, r.first_url, len(r.duplicates)) for r in pages] == [(k, f"u{100 * k:05d}", 100) for k in range(50)]
    urls = lists.select("function_sha", F.explode("duplicates").alias("u"))
    assert urls.where("function_sha = 'hot'").distinct().count() == 5000
    assert urls.count() == 5050


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id", "cast(id % 2 as string) as docstring", "'f' as function")
    kept = curate.filter_docstring(df, ["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert sorted(r.id for r in kept.collect()) == [0, 1]


def test_filter_docstring(spark):
    df = spark.createDataFrame(
        [(1, "d", "f"), (2, "d", None), (3, "d", None), (4, "", "f"), (5, None, "f"), (6, "d", "f"), (7, "e", "f")],
        "id int, docstring string, function string",
    )
    assert sorted(r.id for r in curate.filter_docstring(df, ["id"]).collect()) == [1, 2, 7]
    assert sorted(r.id for r in curate.filter_docstring(df, ["id"], deduplicate=False).collect()) == [1, 2, 3, 6, 7]


def test_merge(spark):
    a = spark.createDataFrame(
        [(1, "d", "f", "old", "p"), (2, None, "f", "old", "p"), (3, "", "f", "old", "p"), (4, "d", "f", "old", "p")],
        "id int, docstring string, function string, source string, parameters string",
    )
    b = spark.createDataFrame([(1, "d", "f", 7), (2, "d", "g", 8)], "id int, docstring string, function string, stars int")
    c = spark.createDataFrame([(1, "f"), (2, "h")], "id int, function string")
    out = curate.merge_datasets([a, b, c], ["id"], ["github", "gitee", "other"])
    assert "parameters" not in out.columns
    got = sorted(((r.source, r.id, r.docstring, r.function, r.stars) for r in out.collect()), key=str)
    # c's first row has no docstring column: its key is ('', f), which a's row 3 took.
    assert got == [
        ("gitee", 2, "d", "g", 8), ("github", 1, "d", "f", None), ("github", 2, None, "f", None),
        ("github", 3, "", "f", None), ("other", 2, None, "h", None),
    ]
    unlabelled = curate.merge_datasets([a], ["id"], drop_keys=[])
    assert {r.source for r in unlabelled.collect()} == {"old"} and "parameters" in unlabelled.columns


def test_licenses(spark):
    records = spark.createDataFrame(
        [("g", "a/x", "MIT", 1), ("g", "a/x", "GPL-3.0", 2), ("g", "a/y", "GPL-3.0", 3), ("g", "a/y", "MIT", 4),
         ("g", "a/z", "MIT", 5), ("g", "a/z", None, 6), (None, "a/w", "mit", 7)],
        "source string, repo string, license string, line_no int",
    )
    table = curate.license_map(records)
    assert {(r.source, r.repo): r.license for r in table.collect()} == {
        ("g", "a/x"): "GPL-3.0", ("g", "a/y"): "MIT", ("g", "a/z"): None, ("", "a/w"): "mit",
    }
    df = spark.createDataFrame(
        [(1, "g", "a/x"), (2, "g", "a/y"), (3, "g", "a/z"), (4, None, "a/w"), (5, "g", "a/none")], "id int, source string, nwo string"
    )
    assert [r.id for r in curate.filter_license(df, table).collect()] == [2]
    assert sorted(r.id for r in curate.filter_license(df, table, any_case=True).collect()) == [2, 4]
    flags = [r.allowed for r in curate.with_allowed_flag(records).orderBy("line_no").collect()]
    assert flags == [True, False, False, True, True, False, False]


def test_pending_and_outcomes(spark):
    units = spark.createDataFrame([("a",), ("b",), ("c",)], "unit string")
    done = spark.createDataFrame([("b",), ("b",)], "unit string")
    assert sorted(r.unit for r in curate.pending_units(units, done, ["unit"]).collect()) == ["a", "c"]
    df = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "unit string, ok boolean")
    good, bad = curate.success_and_failure(df, F.col("ok"))
    assert [r.unit for r in good.collect()] == ["a"] and sorted(r.unit for r in bad.collect()) == ["b", "c"]


@pytest.mark.parametrize("side", [3, 40, 100_000])
def test_skew_join_equals_a_plain_join(spark, side):
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id % 50) as k", "id as v")
    left = left.unionAll(spark.sql("select cast(null as bigint) as k, cast(-1 as bigint) as v"))
    right = spark.range(200).selectExpr("if(id % 4 = 0, 7, id) as k", "id * 10 as w")
    want = left.join(right, ["k"])
    got = skew.skew_join(left, right, ["k"], ["v"], ["w"], side)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_key_hot_on_both_sides_is_cut(spark):
    """Neither side alone has many rows of the key; together they make a million."""
    left = spark.range(1500).selectExpr("if(id < 1000, 7, id) as k", "id as v")
    right = spark.range(1500).selectExpr("if(id < 1000, 7, id) as k", "id as w")
    cut = skew.cells(left, right, ["k"], side=250).collect()
    assert [(r.k, r._left_parts, r._right_parts) for r in cut] == [(7, 4, 4)]
    assert skew.cells(left, right, ["k"], side=1000).count() == 0
    joined = skew.skew_join(left, right, ["k"], ["v"], ["w"], side=250)
    assert joined.count() == 1_000_500


@pytest.mark.parametrize("limit", ["10m", "1g", "-1", "10485760"])
def test_any_broadcast_setting(spark, limit):
    facts = spark.range(2000).selectExpr("cast(if(id % 2 = 0, 1, id % 30) as string) as nwo", "id as unit")
    done = spark.range(25).selectExpr("cast(id as string) as nwo")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert curate.pending_units(facts, done, ["nwo"]).count() == facts.where("cast(nwo as int) >= 25").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_call_links(spark):
    calls = spark.createDataFrame(
        [
            ("a/b", "s", "f1", n, "()", i, i)
            for i, n in enumerate(["Foo", "read_all", "go", "_private_x", "_private", "longenoughname", "stop_word", "other_lib"])
        ] + [("a/b", "s", "f2", "read_all", "()", 9, 9)],
        "nwo string, sha string, path string, identifier string, argument_list string, start_row int, end_row int",
    )
    imports = spark.createDataFrame([("a/b", "f1", "lib"), ("a/b", "f1", "lib"), ("a/b", "f2", "none")], "nwo string, path string, library string")
    definitions = spark.createDataFrame(
        [("lib", "Foo.__init__", "d1"), ("lib", "read_all", "d2"), ("lib", "read_all", "d3"), ("lib", "go", "d4"),
         ("lib", "_private_x", "d5"), ("lib", "_private", "d6"), ("lib", "longenoughname", "d7"), ("lib", "stop_word", "d8"),
         ("elsewhere", "other_lib", "d9")],
        "library string, identifier string, url string",
    )
    got = links.call_links(calls, imports, definitions, stopwords=["stop_word"])
    assert sorted((r.identifier, r.definition_url) for r in got.collect()) == [
        ("Foo", "d1"), ("_private_x", "d5"), ("longenoughname", "d7"), ("read_all", "d2"), ("read_all", "d3"),
    ]
    assert {r.call_url for r in got.where("identifier = 'Foo'").collect()} == {"https://github.com/a/b/blob/s/f1#L1-L1"}


def test_libraries(spark):
    df = spark.createDataFrame([({"x": "lib.sub.Thing", "y": "lib.other"}, ["raw.name"]), (None, None)], "m map<string,string>, l array<string>")
    got = [r[0] for r in df.select(links.libraries_of(F.col("m"), F.col("l"))).collect()]
    assert got == [["lib", "raw.name"], []]


def test_project(spark):
    urls = {
        "https://github.com/o/r": "o/r", "https://github.com/o/r.git": "o/r", "https://gitee.com/o/r.git": "o/r",
        "http://gitee.com/o/r": "o/r", "https://example.com/o/r": None,
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.n for r in df.select("u", project.remote_to_nwo("u").alias("n")).collect()} == urls
    names = [
        ("github", "o/r.git", "o/r"), ("github", "o##r", None), ("gitee", "o##r_arkts", "o/r"), ("gitee", "o/r", "o/r"),
        ("gitee", "plain", None), ("github", "o/r/x", "o/r/x"),
    ]
    df = spark.createDataFrame(names, "s string, n string, want string")
    for r in df.select("want", project.repo_key("n", "s").alias("got")).collect():
        assert r.got == r.want
    nwo, inner = project.path_to_nwo("p")
    df = spark.createDataFrame([("/a/b/o/r/src/x.ets",), ("/a/b/o",), ("short",)], "p string")
    assert [tuple(r) for r in df.select(nwo, inner).collect()] == [("o/r", "src/x.ets"), ("o", ""), ("", "")]
    df = spark.createDataFrame([("src/Test/a.ets",), ("x/node_modules/a.ets",), ("src/a.ets",)], "p string")
    assert [r.p for r in df.where(project.is_source_path("p")).collect()] == ["src/a.ets"]
    df = spark.createDataFrame([("中" * 10,), ("a" * 10,)], "c string")
    assert df.where(project.within_size("c", 12)).count() == 1
    df = spark.createDataFrame([("Arkts",), ("go",)], "l string")
    assert df.where(project.is_supported_language("l")).count() == 1


def test_function_record_defaults(spark):
    df = spark.createDataFrame(
        [("　doc ", "doc @x", "\x1cfn()\n", ["fn", "(", ")"], 0, 2)],
        "docstring string, docstring_summary string, function string, function_tokens array<string>, start_row int, end_row int",
    )
    r = project.function_record(df).first()
    assert (r.nwo, r.docstring, r.function, r.imports, r.docstring_tokens) == ("", "doc", "fn()", [], ["doc", "@x"])
    assert r.url == "https://github.com//blob//#L1-L3"
    assert project.function_record(df).columns == project.FUNCTION_COLUMNS


def test_payloads(spark):
    cases = [
        ("github", '{"license": {"spdx_id": "Apache-2.0"}}', "Apache-2.0"), ("github", '{"license": null}', None),
        ("github", "{}", None), ("github", '{"license": {"spdx_id": ""}}', None), ("github", "broken", None),
        ("gitee", '{"license": "mit"}', "MIT"), ("gitee", '{"license": "", "spdx": "bsd-3-clause"}', "BSD-3-CLAUSE"), ("gitee", "{}", None),
    ]
    df = spark.createDataFrame(cases, "s string, p string, want string")
    for r in df.select("want", pages.license_from_payload("p", "s").alias("got")).collect():
        assert r.got == r.want


def test_listing(spark):
    html = (
        '<div class="items">no</div><div class="item x"><h3><a class="title project-namespace-path" href=" /o/r " title=" o/r ">r</a></h3>'
        '<div class="stars-count" data-count="many"></div><div class="project-desc" title="a &quot;b&quot; &amp;lt;"></div></div>'
        "<div class='item'><h3><a class='project-namespace-path title' title='q/w' href='/q/w'></a></h3><div class='stars-count' data-count='12'></div>"
        "<a class='project-language' title='TypeScript'></a></div><div class='item'><h3><a title='none'></a></h3></div>"
    )
    df = spark.createDataFrame([(1, html), (2, "<html></html>")], "page_id int, html string")
    got = [tuple(r)[2:] for r in pages.listing_items(df).orderBy("item").collect()]
    assert got == [("o/r", "https://gitee.com/o/r", 0, 'a "b" &lt;', ""), ("q/w", "https://gitee.com/q/w", 12, "", "TypeScript")]
