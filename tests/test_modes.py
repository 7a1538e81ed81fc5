"""The mode stack, its composition over chunks, and extraction from segments."""

import random

import pytest
from codequarry.functions import lexing
from codequarry.functions.modes import Modes, whole_literals
from codequarry.operators import extract, segments
from pyspark.sql import functions as F


def code(rng, depth=0):
    """Random code by a small grammar, without comments: [(text, is a literal)]."""
    def expression(d):
        k = rng.randrange(9 if d < 4 else 5)
        if k == 0:
            return [("'it\\'s {(' + ".rstrip("+ "), True)]
        if k == 1:
            return [(rng.choice(["/[/*]+/g", "/`/", "/'/", "/[{(\"']/", "/a\\/b}/i"]), True)]
        if k == 2:
            return [(f"v{rng.randrange(50)}", False)]
        if k == 3:
            return [(f"v{rng.randrange(9)} / 2 / (1 + 3) / k[0] / w! / 5", False)]
        if k == 4:
            return [('"// no comment"', True)]
        if k == 5:
            return [("[", False), *expression(d + 1), (", { a: ", False), *expression(d + 1), (" }]", False)]
        if k == 6:
            return [("f(", False), *expression(d + 1), (")", False)]
        if k == 7:
            inner = "".join(t for t, _ in expression(d + 1))
            return [("`x } ${" + inner + "} { \\` /* ${" + rng.choice(["x", "`}`", "`${`{`}`"]) + "}`", True)]
        return [("(q => { return ", False), *expression(d + 1), (" })", False)]

    def statement(d):
        k = rng.randrange(5 if d < 3 else 3)
        if k < 2:
            return [(f"let a{rng.randrange(99)} = ", False), *expression(d), (";\n", False)]
        if k == 2:
            return [("if (a) ", False), ("/'/", True), (".test(b); else ", False), ("/`/", True), (".test(c)\n", False)]
        if k == 3:
            return [(f"function g{rng.randrange(99)}(s, t) {{\n", False), *block(d + 1), ("}\n", False)]
        return [(f"class C{rng.randrange(99)} {{\n  m(a) {{\n", False), *block(d + 1), ("  }\n}\n", False)]

    def block(d):
        return [p for _ in range(rng.randrange(1, 4)) for p in statement(d)]

    return [p for _ in range(rng.randrange(3, 12)) for p in statement(0)]


def texts(seed, comments=True):
    rng = random.Random(seed)
    text = "".join(t for t, _ in code(rng))
    if comments:
        lines = text.split("\n")
        for _ in range(len(lines) // 3):
            lines.insert(rng.randrange(len(lines) + 1), "")
        text = "\n".join(lines)
    return text


@pytest.mark.parametrize("seed", range(60))
def test_literals_are_the_grammars(seed):
    parts = code(random.Random(seed))
    text = "".join(t for t, _ in parts)
    at, want = 0, []
    for t, literal in parts:
        if literal:
            want.append(t)
        at += len(t)
    assert [text[a:b] for a, b in whole_literals(text)] == want


def test_code_without_comments_stays_as_it_is(spark):
    rows = spark.createDataFrame([(i, texts(i)) for i in range(80)], "id int, content string")
    got = rows.select("content", lexing.remove_comments("content").alias("code"), F.array_join(lexing.lex("content"), "").alias("all"))
    assert all(r.code == r.content == r.all for r in got.collect())


def test_adjoining_comments_are_tokens_of_their_own():
    text = "a / 2 // one\n  // two\n/* three *//* four */"
    assert [text[a:b] for a, b in whole_literals(text)] == ["// one", "// two", "/* three */", "/* four */"]


def test_only_comments_go(spark):
    source = "let a = /[/*]+/ // one\nlet b = `${f(`//x`)} /* no */` /* two */ + 1 / 2 // three / four\n"
    rows = spark.createDataFrame([(source,)], "content string")
    r = rows.select(lexing.remove_comments("content").alias("code"), lexing.comments_of("content").alias("c")).first()
    assert r.c == ["// one", "/* two */", "// three / four"]
    assert r.code == "let a = /[/*]+/ \nlet b = `${f(`//x`)} /* no */`  + 1 / 2 \n"


@pytest.mark.parametrize("seed", range(40))
def test_composed_states_are_those_of_one_pass(seed):
    rng = random.Random(seed)
    text = texts(seed) + "/* open\n" * (seed % 3 == 0) + "`${`" * (seed % 3 == 1)
    lines = text.splitlines(keepends=True)
    chunks, at = [], 0
    while at < len(lines):
        n = rng.randrange(1, 6)
        chunks.append("".join(lines[at : at + n]))
        at += n
    state, done = ("code", []), ""
    for chunk in chunks:
        state = segments.composed(state, segments.summary(chunk))
        done += chunk
        one = Modes()
        for _ in one.scan(done):
            pass
        assert (state[0], [b for b, _ in state[1]]) == (one.mode, [b for b, _ in one.stack])


def files(spark, contents):
    return spark.createDataFrame(list(enumerate(contents)), "file_id long, content string")


def large(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        out.append(f"\n// about {i}\n/* more */\n" if rng.random() < 0.5 else "\n")
        out.append(f"export function top{i}(a: number, b = `${{x}}`) {{\n{texts(seed * 1000 + i)}}}\n")
        if rng.random() < 0.2:
            out.append("const s = {\n  go(x) { return `\n}\nfunction no() {\n}\n${x}` }\n}\n")
    return "".join(out)


@pytest.mark.parametrize("chunk", [300, 5000])
def test_segments_give_the_rows_of_whole_files(spark, chunk):
    contents = [large(1, 40), large(2, 25), "function small() { }\n", None, "", "x" * 2000, large(3, 3) + "`" + "y\n" * 500]
    table = files(spark, contents)
    cut = segments.segments(table, chunk)
    back = {}
    for r in sorted(cut.collect(), key=lambda r: (r.file_id, r.segment)):
        assert r.first_row == back.get(r.file_id, "").count("\n")
        back[r.file_id] = back.get(r.file_id, "") + r.content
    assert back == {i: c for i, c in enumerate(contents) if c is not None}
    assert cut.where("file_id = 0").count() > 10

    def rows(split):
        return sorted(map(tuple, extract.extract_functions(table, split_above=split).drop("exported").collect()))

    assert rows(chunk) == rows(None) != []


def test_large_files_are_cut(spark):
    text = large(5, 400)
    sizes = [len(r.content) for r in segments.segments(files(spark, [text]), 20_000).collect()]
    assert len(text) > 150_000 and len(sizes) > 20 and max(sizes) < 20_000


def test_chunks_are_cut_once(spark):
    cut = segments.segments(files(spark, [large(1, 40), large(2, 25)]), 300)
    cut.collect()
    plan = cut._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")].split("\n")
    assert any("ReusedExchange" in line for line in final) and sum("ArrowEvalPython [_parts" in line for line in final) == 1
