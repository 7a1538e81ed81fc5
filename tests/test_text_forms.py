"""Text forms of functions from one reading of each text."""

from pyspark.sql import functions as F

from codequarry.functions import lexing
from codequarry.operators import extract
from codequarry.operators.project import function_record

# (function, parameters): borders inside strings, comments and escapes, in templates and regexes.
ODD = [
    ("function f(a, b) { return a.b + b }", "(a, b)"),
    ("@D(a) m(a: T<{x: y}>): {z: a} { // a\n a() }", "(a: T<{x: y}>)"),
    ("@D('(a)') m(a) { return a }", "(a)"),
    ("/// c (a)\n[`\\()", "()"),
    ("f(x) // {\n { x }", "(x)"),
    ("f(x /* ) */) { /x/.test(x) / 2 }", "(x /* ) */)"),
    ("f(s) { return `a ${s} b` }", "(s)"),
    ("x => x + 1", ""),
    ("f { \"open", "(x)"),
    ("", "()"),
]


def _rows(spark):
    rows = [(i, f, p, "doc") for i, (f, p) in enumerate(ODD)]
    return spark.createDataFrame(rows, "id int, function string, parameters string, docstring string")


def test_forms_are_those_of_separate_readings(spark):
    rows = _rows(spark)
    want = {
        r["id"]: (r["t"], r["o"], r["n"])
        for r in rows.select(
            "id", lexing.code_tokens("function").alias("t"),
            F.array_join(lexing.obfuscated("function", "parameters", keep_space=True), "").alias("o"),
            lexing.obfuscated("function", "parameters").alias("n"),
        ).collect()
    }
    got = extract.with_text_forms(rows).collect()
    assert {r["id"]: (r["function_tokens"], r["obf_function"], r["obf_function_tokens"]) for r in got} == want


def test_kept_rows_read_a_text_in_five_places_only(spark):
    rows = _rows(spark).withColumn("identifier", F.lit("f"))
    plan = extract.kept_rows(rows)._jdf.queryExecution().optimizedPlan().toString()
    # Each reading has two places, of texts cut by patterns and of those between literals.
    assert plan.count(r"=>|\.\.\.|===") <= 10


def test_record_strips_both_ends(spark):
    texts = ["", " ", "a", " a", "a\n", "\x1ca b ", "　x　", "é\t"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "start_row int, function string").withColumn("end_row", F.lit(0))
    got = {r["start_row"]: r["function"] for r in function_record(rows, "start_row").select("start_row", "function").collect()}
    assert got == {i: t.strip() for i, t in enumerate(texts)}
