"""Function extraction on literal source files."""

import pytest
from pyspark.sql import functions as F

from codequarry.operators import extract

SAMPLE = """// geometry helpers
// for screen tiles

function add(left: Point, right: Point): Point {
    let sum = new Point(left.x + right.x)
    return sum.clamp(left.limit)
}

function multiply(tile: Tile, times: number): Tile {
    if (times < 1) { return Tile.none() }
    return tile.repeat(times)
}
"""

CASES = {
    "nested": (
        "function outer(a) {\n  function inner(b) { return b }\n  return inner(a)\n}",
        [("function", "outer", "(a)"), ("function", "inner", "(b)")],
    ),
    "braces in literals and comments": (
        "function f() {\n  let a = '}'; let b = \"{\"; let c = `}${x}{`\n  // }\n  /* { */\n  return /a/ }\nfunction g() {}",
        [("function", "f", "()"), ("function", "g", "()")],
    ),
    "arrows": (
        "const f = (a, b) => { return a }\nconst g = x => x + 1;\nlist.map((y) => y * 2, 3)\nfoo(z => ({ z: 1 }))",
        [("arrow", "", "(a, b)"), ("arrow", "x", ""), ("arrow", "", "(y)"), ("arrow", "z", "")],
    ),
    "class": (
        "export class A extends B {\n  constructor(n: string) { super(n) }\n  private async go<T>(x: T): Promise<T> {\n"
        "    if (x) { while (true) { break } } else { try { a() } catch (e) { b() } }\n    switch (x) { default: }\n  }\n  get size(): number { return 1 }\n}",
        [("export", "A", ""), ("constructor", "constructor", "(n: string)"), ("method", "go", "(x: T)"), ("method", "size", "()")],
    ),
    "component": (
        "@Entry\n@Component\nstruct Index {\n  @State n: number = 0\n  build() {\n    Column({ space: 5 }) {\n      Text('a').onClick(() => { this.n++ })\n    }\n  }\n}",
        [("build", "build", "()"), ("arrow", "", "()")],
    ),
    "exports and decorators": (
        "export function a() { }\nexport default function b(x: number) { }\n@Builder\nfunction c() { }\n@Builder\nexport function d() { }",
        [("export", "a", "()"), ("export", "b", "(x: number)"), ("decorated_function", "c", "()"), ("decorated_export", "d", "()")],
    ),
    "expressions": (
        "let k = function (u) { return u }\nfoo(function named(v) { })\n",
        [("function_expression", "", "(u)"), ("function_expression", "named", "(v)")],
    ),
    "multi-line parameters": ("function f(\n  a: number,\n  b: (c: string) \n) {\n}", [("function", "f", "(\n  a: number,\n  b: (c: string) \n)")]),
    "callback types": (
        "function f(cb: (x: number) => void) { cb(1) }\nclass A {\n  method(cb: (x: number) => void): void { }\n  on: (e: Event) => void = (e) => { }\n}",
        [("function", "f", "(cb: (x: number) => void)"), ("method", "method", "(cb: (x: number) => void)"), ("arrow", "", "(e)")],
    ),
    "types in signatures": (
        "function a(): () => void { return g }\nfunction b(a: number): { x: number } { return { x: a } }\nfunction c(a: { x: number }) { }\n"
        "function d(a = {}) { }\nfunction e(a = g(h(i(j(k(1)))))) { }\nfunction f<T extends Map<string, Array<T>>>(x: T): Map<string, Array<T>> { }",
        [("function", "a", "()"), ("function", "b", "(a: number)"), ("function", "c", "(a: { x: number })"), ("function", "d", "(a = {})"),
         ("function", "e", "(a = g(h(i(j(k(1))))))"), ("function", "f", "(x: T)")],
    ),
    "method names": (
        "class A {\n  Foo(a: number) { }\n  Bar() { }\n  [Symbol.iterator]() { }\n  'a-b'() { }\n  #p() { }\n  foo?() { }\n  *gen() { }\n}",
        [("method", n, p) for n, p in [("Foo", "(a: number)"), ("Bar", "()"), ("[Symbol.iterator]", "()"), ("'a-b'", "()"), ("#p", "()"), ("foo", "()"), ("gen", "()")]],
    ),
    "arrow types and bodies": (
        "const f = (a: number): Map<string, {x: number}> => { return m }\nconst g = a => b => a + b\nconst h = (a) => a\n  .b()\n  .c()\nlet z = 1",
        [("arrow", "", "(a: number)"), ("arrow", "a", ""), ("arrow", "b", ""), ("arrow", "", "(a)")],
    ),
    "types only": (
        "type F = (x: number) => void\ninterface I {\n  on: (e: Event) => void\n  go(): void\n}\nlet k: (x: number) => void\ndeclare function q(a: () => void): void;\n", [],
    ),
    "other exports": (
        "export const x = 1\nexport interface I { }\nexport const f = (a) => a\n@Component\nexport struct S { build() { } }",
        [("export", "x", ""), ("export", "I", ""), ("export", "f", ""), ("arrow", "", "(a)"), ("decorated_export", "S", ""), ("build", "build", "()")],
    ),
    "object literals": (
        "let o = {\n  go(x) { return x },\n  on: (e) => { },\n  v: function (u) { }\n}\nRow() {\n  Text('a')\n}",
        [("method", "go", "(x)"), ("arrow", "", "(e)"), ("function_expression", "", "(u)")],
    ),
    "comments anywhere": (
        "function f(a /* one ( */, b // two {\n) /* three } */ {\n}\nfunction g() { return /* ) */ 1 }", [("function", "f", "(a /* one ( */, b // two {\n)"), ("function", "g", "()")],
    ),
    "slashes in regex classes": (
        "function a(s) { return s.replace(/[/*]+/g, '') }\nfunction b(x) { return x }\nfunction c() { }",
        [("function", "a", "(s)"), ("function", "b", "(x)"), ("function", "c", "()")],
    ),
    "backtick in a regex": ("function a(s) { return s.match(/`/) }\nfunction b() { }", [("function", "a", "(s)"), ("function", "b", "()")]),
    "quote in a regex": ("function a(s) { return s.split(/'/) }\nfunction b() { }", [("function", "a", "(s)"), ("function", "b", "()")]),
    "brackets in a regex": (
        "function a(s) { return s.replace(/[{(\"']/g, '') }\nfunction after() { }", [("function", "a", "(s)"), ("function", "after", "()")],
    ),
    "nested templates": (
        "function t(x) {\n  return `x ${ [1].map(q => { return `}` + q }).join(`{`) } y`\n}\nfunction u() { }",
        [("function", "t", "(x)"), ("arrow", "q", ""), ("function", "u", "()")],
    ),
    "comment marks in a hole": ("function a() { return `${f(`//x`)}` ; }\nfunction b() { }", [("function", "a", "()"), ("function", "b", "()")]),
    "division": (
        "function a(n) { let k = n / 2; let r = (n + 1) / k / 3; return a[0] / 2 + x! / 4 /* ' */ }\nfunction b(s) { if (s) /'/.test(s); return `${s}`.length / 2 }\nfunction c() { }",
        [("function", "a", "(n)"), ("function", "b", "(s)"), ("function", "c", "()")],
    ),
    "unclosed": ("function f() {\n  return {", []),
    "nothing": ("let a = { b: 1 }\nif (a) { }\n", []),
    "empty": ("", []),
}


def files(spark, contents):
    return spark.createDataFrame([(str(k), f"{k}.ets", c) for k, c in contents.items()], "file_id string, path string, content string")


def test_sample(spark):
    rows = extract.function_rows(files(spark, {"s": SAMPLE})).collect()
    by_name = {r.identifier: r for r in rows}
    assert set(by_name) == {"add", "multiply"}
    add = by_name["add"]
    assert add.function == SAMPLE[SAMPLE.index("function add"):SAMPLE.index("\n\nfunction multiply")]
    assert add.docstring == "geometry helpers for screen tiles"
    assert add.url.endswith("s.ets#L4-L7") and by_name["multiply"].url.endswith("#L9-L12")
    assert add.obf_function == (
        "function add(arg_0: Point, arg_1: Point): Point {\n    let arg_2 = new arg_3(arg_0.x + arg_1.x)\n    return arg_2.clamp(arg_0.limit)\n}"
    )
    assert add.function_tokens[:4] == ["function", "add", "(", "left"]
    assert by_name["multiply"].docstring == ""


def test_constructs(spark):
    found = extract.extract_functions(files(spark, {k: c for k, (c, _) in CASES.items()})).collect()
    for name, (content, want) in CASES.items():
        got = sorted((r for r in found if r.file_id == name), key=lambda r: (r.start_row, r.start_col))
        assert [(r.kind, r.identifier, r.parameters) for r in got] == want, name
        lines = content.split("\n")
        for r in got:
            assert r.function in content
            cut = "\n".join(lines[r.start_row:r.end_row + 1])
            assert cut[r.start_col:].startswith(r.function), name
            assert len(r.function.split("\n")[-1]) + (r.start_col if r.start_row == r.end_row else 0) == r.end_col
            assert r.kind in extract.KINDS


def test_bodies(spark):
    found = extract.extract_functions(files(spark, {k: c for k, (c, _) in CASES.items()}))
    texts = {(r.file_id, r.identifier or r.parameters): r.function for r in found.collect()}
    assert texts["arrows", "x"] == "x => x + 1"
    assert texts["arrows", "(y)"] == "(y) => y * 2"
    assert texts["arrows", "z"] == "z => ({ z: 1 })"
    assert texts["braces in literals and comments", "f"].endswith("return /a/ }")
    assert texts["exports and decorators", "d"] == "@Builder\nexport function d() { }"
    assert texts["class", "go"].startswith("private async go<T>")
    assert texts["class", "A"] == CASES["class"][0]
    assert texts["types in signatures", "b"] == "function b(a: number): { x: number } { return { x: a } }"
    assert texts["types in signatures", "a"] == "function a(): () => void { return g }"
    assert texts["arrow types and bodies", "(a: number)"] == "(a: number): Map<string, {x: number}> => { return m }"
    assert texts["arrow types and bodies", "a"] == "a => b => a + b" and texts["arrow types and bodies", "b"] == "b => a + b"
    assert texts["arrow types and bodies", "(a)"] == "(a) => a\n  .b()\n  .c()"
    assert texts["other exports", "x"] == "export const x = 1" and texts["other exports", "f"] == "export const f = (a) => a"
    assert texts["other exports", "S"] == "@Component\nexport struct S { build() { } }"


@pytest.mark.parametrize("before, want", [
    ("/** one\n * two */\n", "one\ntwo"),
    ("// Copyright a, license b\n// kept\n", "kept"),
    ("// Copyright a, license b\n", "Copyright a, license b"),
    ("// far\n\n// c2\n// c1\n", "c2 c1"),
    ("// c2\n\n// c1\n", "c2 c1"),
    ("// c4\n\n// c3\n// c2\n\n// c1\n\n", "c3 c2 c1"),
    ("let a = 1 // note\n", "note"),
    ("// other\nlet a = 1\n", ""),
    ("", ""),
])
def test_docstring(spark, before, want):
    rows = extract.extract_functions(files(spark, {"f": before + "function f() { }"})).collect()
    assert [r.docstring for r in rows] == [want]


def test_docstring_of_bound_arrow(spark):
    source = "// about f\nconst f = (a) => { return a }\n// about g\ncall((b) => { })\n"
    rows = extract.extract_functions(files(spark, {"f": source})).collect()
    assert {r.parameters: r.docstring for r in rows} == {"(a)": "about f", "(b)": ""}


def test_job_filters(spark):
    rows = spark.createDataFrame(
        [
            ("/data/repos/o/r/src/a.ets", "s1", "class A {\n  toString(): string { return '' }\n  keep() { return 1 }\n}"),
            ("/data/repos/o/r/src/Test.ets", "s1", "function t() { }"),
            ("/data/repos/o/r/src/big.ets", "s1", "function big() { }" + " " * 2000),
        ],
        "path string, sha string, content string",
    )
    got = extract.repository_rows(rows, max_bytes=1000).collect()
    assert [(r.nwo, r.path, r.sha, r.identifier) for r in got] == [("o/r", "src/a.ets", "s1", "keep")]


def test_status(spark):
    f = files(spark, {"ok": "function f() { }", "no": "let a = 1", "big": "function g() { }" + " " * 100, "empty": ""})
    got = {r.status: r.files for r in extract.extract_status(f, 64).collect()}
    assert got == {"ok": 1, "unmatched": 2, "too_large": 1}


def test_one_shuffle_of_the_text(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = extract.extract_functions(files(spark, {"s": SAMPLE}).select("file_id", "content"))
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        final = plan[: plan.index("Initial Plan")]
        assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") <= 1 or "ReusedExchange" in final
        assert "Window" in final and "BatchEvalPython" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_many_files_stay_apart(spark):
    n = 300
    f = spark.range(n).select(
        F.col("id").alias("file_id"), F.concat(F.lit("function f"), "id", F.lit("(a) { if (a) { return 1 } }\n"), F.lit("let x = 1\n")).alias("content")
    )
    rows = extract.extract_functions(f).collect()
    assert len(rows) == n and all(r.identifier == f"f{r.file_id}" for r in rows)


def test_marks_are_neither_sorted_nor_shuffled(spark):
    """What is found in a file comes out of one reading: no task holds a partition's marks."""
    texts = files(spark, {"s": SAMPLE}).select("file_id", "content")
    plan = extract._files_with_finds(texts)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_only_scopes_with_finds_are_dealt_again(spark):
    texts = files(spark, {"s": SAMPLE}).select("file_id", "content")
    plan = extract._found(texts)._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")
    assert len(plan) == 2 and "Window" in plan[0] and "Window" not in plan[1]
    assert "finds" in plan[1] and "Generate posexplode" not in plan[1]


def test_a_text_passes_to_python_once(spark):
    """Its marks are cut, placed and gathered in one step: none of them travels on its own."""
    texts = spark.createDataFrame([(1, SAMPLE)], "file_id long, content string")
    for found in (extract._found(texts), extract._files_with_finds(texts)):
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("ArrowEvalPython [") == 1


def test_docstrings_without_functions(spark):
    """The same docstrings and names, from files cut in pieces and from short ones, read plain or not."""
    one = "// about f{0}\nfunction f{0}(a) {{ return '{1}' }}\nclass C{0} {{\n  /** ä{0} */\n  'm-{0}'(x: () => void): void {{ }}\n}}\n"
    files = [
        (k, "".join(one.format(i, tail * (k * 40)) for i in range(k)) + odd)
        for k in (0, 1, 40) for tail, odd in (("x", ""), ("é", ""), ("z", "let r = a / b / `${() => { }}`"))
    ]
    files = [(i, content) for i, (_, content) in enumerate(files)] + [(99, None)]
    df = spark.createDataFrame(files, "file_id long, content string")
    assert max(len(c or "") for _, c in files) * 80 > extract._SHORT > 8 * len(one)
    whole = extract.extract_functions(df)
    rows = sorted(map(tuple, extract.with_docstrings(df).select("file_id", "kind", "identifier", "docstring").collect()))
    assert rows == sorted(map(tuple, whole.select("file_id", "kind", "identifier", "docstring").collect()))
    for i, content in files[:-1]:
        n = [0, 1, 40][i // 3]
        of_file = sorted(r[2:] for r in rows if r[0] == i and r[1] != "arrow")
        assert of_file == sorted([(f"'m-{j}'", f"ä{j}") for j in range(n)] + [(f"f{j}", f"about f{j}") for j in range(n)])
    for r in whole.where("kind = 'function'").collect():
        content = dict(files)[r["file_id"]]
        assert r["function"] in content and r["function"].startswith(f"function {r['identifier']}(a) {{")
