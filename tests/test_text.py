"""Text functions on edge cases, and against plain-Python statements of the rules."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codequarry.functions import hashing, lexing, text

SAMPLES = [
    "", " ", "a", "a b", "A  B\tc", " x　y ", "\x1c sep \x1f", "中文 只有", "don't (stop) {} [] => ...",
    "`a`:b;c==d--e//f\\g", "a.b.c", "x_1 y2", "/** doc */", " * line\n// two\n/* three */\n**", "\u0085next\v\f",
    "one\n\ntwo @param", "@first", "no marks", "a#b##", "tail\n\n", "ÄÖÜ straße ÉCOLE",
]


def py_strip_comment(c):
    out = []
    for line in c.split("\n"):
        line = line.strip()
        line = line.removesuffix("*/")
        for mark in ("*", "/**", "//", "/*"):
            if line.startswith(mark):
                line = line[len(mark):]
                break
        out.append(line.strip())
    return "\n".join(out)


def py_shingles(s):
    toks = re.findall("[a-zA-Z0-9_]+", s)
    if len(toks) < 3:
        return {"".join(toks)} if toks else set()
    return {" ".join(toks[i:i + 3]) for i in range(len(toks) - 2)}


def py_summary(d):
    head, gap, _ = d.partition("\n\n")
    return head if gap else d.partition("@")[0]


def py_normal(s):
    return re.sub(r"\s+", " ", s.strip().lower())


def evaluate(spark, samples, **cols):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    return df.select("i", "s", *[c.alias(n) for n, c in cols.items()]).orderBy("i").collect()


def check_rules(spark, samples):
    rows = evaluate(
        spark, samples, strip=text.strip("s"), norm=text.normalize("s"), words=text.word_tokens("s"),
        sh=text.shingles("s"), bare=text.strip_comment("s"), summary=text.docstring_summary("s"),
        sha=hashing.function_sha("s", "s"), lines=text.line_count("s"), n=text.char_count("s"),
        ast=text.ast_length("s"), lic=text.is_license_comment("s"), lexed=F.array_join(lexing.lex("s"), ""),
    )
    for r in rows:
        s = r.s
        assert r.strip == s.strip()
        assert r.norm == py_normal(s)
        assert r.words == re.findall("[a-zA-Z0-9_]+", s)
        assert set(r.sh) == py_shingles(s) and len(r.sh) == len(set(r.sh))
        assert r.bare == py_strip_comment(s)
        assert r.summary == py_summary(s)
        assert r.sha == hashlib.sha1((s + "\n" + s).encode()).hexdigest()
        assert r.lines == (len(s.split("\n")) if s else 0)
        assert r.n == len(s)
        assert r.ast == (len(s.split("#")) if s else 0)
        assert r.lic == all(w in s.lower() for w in ("copyright", "license"))
        assert r.lexed == s


def test_rules_on_samples(spark):
    check_rules(spark, SAMPLES + ["Copyright X, License Y", "COPYRIGHT only"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from("aB1_ \t\n#@*/.,'\"`{}()[]\\\xa0　\x1cé中"), max_size=40), min_size=1, max_size=30))
def test_rules_on_random_text(spark, samples):
    check_rules(spark, samples)


def test_docstring_tokens(spark):
    cases = {
        "Adds a, b.": ["Adds", "a", "b", "."],
        "call foo() {} [] => x": ["call", "foo", "()", "{}", "[]", "=", ">", "x"],
        "a+b-c/d": ["a", "+", "b", "-", "c", "/", "d"],
        "...!! don't": ["...", "!!", "don", "t"],
        "中文，字符 ok": ["中文，字符", "ok"],
        "((x)) **y** \\\\": ["((", "x", "))", "**", "y", "**", "\\\\"],
        "": [],
    }
    for r in evaluate(spark, list(cases), t=text.docstring_tokens("s")):
        assert r.t == cases[r.s]


def test_nulls(spark):
    df = spark.createDataFrame([(None,)], "s string")
    r = df.select(
        text.normalize("s").alias("n"), text.line_count("s").alias("l"), text.ast_length("s").alias("a"),
        text.has_text("s").alias("h"),
    ).first()
    assert (r.n, r.l, r.a, r.h) == ("", 0, 0, False)


@pytest.mark.parametrize("a, b, want", [("", "", 1.0), ("x", "", 0.0), ("a b c", "b c d", 0.5), ("a a", "a", 1.0)])
def test_jaccard(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(text.token_jaccard("a", "b").alias("j")).first().j == want


def test_exact_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None), ("1:a", ""), ("1", ":a")], "a string, b string")
    assert df.select(hashing.exact_key("a", "b").alias("k")).distinct().count() == 5


def test_minhash_matches_the_definition(spark):
    samples = ["", "one", "one two", "the quick brown fox jumps over the lazy dog " * 5, " ".join(str(i) for i in range(6000))]
    a, b = hashing.permutations()
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    for r in hashing.with_minhash(df, hashing.shingle_hashes("s"), "sig").collect():
        hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % hashing.PRIME for x in py_shingles(r.s)]
        want = [min((x * h + y) % hashing.PRIME for h in hashes) for x, y in zip(a, b)] if hashes else None
        assert r.sig == want


def test_obfuscation(spark):
    cases = [
        ("function f(a: Foo, b) {\n  // gone\n  return a.b + b + g(a)\n}", "(a: Foo, b)",
         "function f(arg_0: Foo, arg_1) {\n  \n  return arg_0.b + arg_1 + arg_2(arg_0)\n}"),
        ("(été: number) => { return été }", "(été: number)", "(arg_0: number) => { return arg_0 }"),
        ("x => x + 1", "", "arg_0 => arg_0 + 1"),
        ("go(): Foo { return 'a.b' }", "()", "go(): Foo { return 'a.b' }"),
    ]
    df = spark.createDataFrame(cases, "f string, p string, want string")
    for r in df.select("want", F.array_join(lexing.obfuscated("f", "p", keep_space=True), "").alias("got")).collect():
        assert r.got == r.want


def test_long_literals_do_not_overflow(spark):
    big = "const s = '" + "\\u4e2d" * 100_000 + "'; /* " + "* x" * 100_000 + " */ // " + "y" * 100_000
    df = spark.createDataFrame([(big,)], "s string")
    r = df.select(lexing.code_tokens("s").alias("t"), lexing.comments_of("s").alias("c")).first()
    assert len(r.t) == 7 and len(r.c) == 2
