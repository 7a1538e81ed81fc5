import hashlib
import random
import re
import time

import pytest
from cases import awkward, bag, documents, empty, plain

from codequarry.llm import pii


def brute(text):
    def luhn(d):
        return sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(d[::-1])) % 10 == 0

    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    email = re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ip = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    card = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    phone = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    return {
        "email": [m.span() for m in email],
        "ip": [m.span() for m in ip if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in card if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in phone if 8 <= len(digits(m)) <= 15],
    }


def test_base_spans():
    rnd = random.Random(5)
    parts = ["a", "b@c.d", "@", ".", "1", "2", "255", "256", "+", " ", "-", "(", ")", "4111 1111 1111 1111", "0", "é", "_", "\n"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("write to john.doe (at) example (dot) com today", "email", "john.doe (at) example (dot) com"),
        ("john at example dot co dot uk", "email", "john at example dot co dot uk"),
        ("x [at] y.org", "email", "x [at] y.org"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),  # two Cyrillic letters
        ("ｊohn＠example．com", "email", "ｊohn＠example．com"),
        ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("card four one one one 1111 1111 one one one one ok", "card", "four one one one 1111 1111 one one one one"),
        ("ring plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
        ("at one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
        ("192.168​.0.1", "ip", "192.168​.0.1"),
    ],
)
def test_disguises(text, kind, found):
    assert [text[a:b] for a, b in pii.all_spans(text)[kind]] == [found]
    assert pii.base_spans(text)[kind] == []
    assert f"<{kind.upper()}>" in pii.masked(text) and found not in pii.masked(text)


@pytest.mark.parametrize(
    "text",
    [
        "meet me at example.com tomorrow",
        "look at the dot com boom",
        "one two three go",
        "point one, point two and a dot",
        "Привет, мир: это обычный текст",
        "at nine (at) noon",
        "the dot is at home",
    ],
)
def test_plain_texts_stay(text):
    assert pii.listed(pii.all_spans(text)) == "" and pii.masked(text) == text


def test_base_spans_always_stay():
    text = "jo​hn@ex.com and a@b.com"
    spans = pii.all_spans(text)["email"]
    assert set(pii.base_spans(text)["email"]) <= set(spans) and (0, 12) in spans
    assert pii.masked(text) == "<EMAIL> and <EMAIL>"


@pytest.mark.parametrize(
    "text",
    ["a" * 10**6, "1" * 10**6, "1." * 300_000, "one " * 100_000, "a@" * 200_000, "x at " * 100_000 + " dot ", "(at)" * 100_000, "+1 " * 200_000],
)
def test_linear(text):
    start = time.process_time()
    pii.all_spans(text)
    assert time.process_time() - start < 12


@pytest.mark.parametrize("source", [awkward, documents])
def test_find(spark, source):
    docs = source(spark)
    want = []
    for i, t in plain(docs):
        base = brute(t)
        text = ",".join(f"{k}:{a}:{b}" for k in ("email", "ip", "card", "phone") for a, b in base[k])
        want.append((i, *(len(base[k]) for k in base), hashlib.sha256(text.encode()).hexdigest(), pii.listed(pii.all_spans(t))))
    assert bag(map(tuple, pii.find(docs).collect())) == bag(want)


def test_redacted(spark):
    docs = awkward(spark).union(
        spark.createDataFrame([(50, "Mail a@b.org!", "en", None, 13, "d", "r", None, "k", "m")], awkward(spark).schema)
    )
    got = pii.redacted(docs)
    assert got.columns == docs.columns and got.schema["n_chars"] == docs.schema["n_chars"]
    rows = {(r["doc_id"], r["text"], r["n_chars"]) for r in got.collect()}
    assert (50, "Mail <EMAIL>!", 13) in rows and (4, None, None) in rows
    assert pii.redacted(empty(spark)).collect() == [] and pii.find(empty(spark)).collect() == []


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("host 192 dot 168 dot 1 dot 10 up", "ip", "192 dot 168 dot 1 dot 10"),
        ("192[.]168[.]1[.]1", "ip", "192[.]168[.]1[.]1"),
        ("10(dot)0(dot)0(dot)1", "ip", "10(dot)0(dot)0(dot)1"),
        ("192.168.1[.]1", "ip", "192.168.1[.]1"),
        ("ten 10[.]zero[.]0[.]1", "ip", "10[.]zero[.]0[.]1"),
        ("one two three 192 dot 168 dot 1 dot 10", "ip", "192 dot 168 dot 1 dot 10"),
        ("call +44 seven 700 900 one 23 now", "phone", "+44 seven 700 900 one 23"),
        ("plus 44 7700 900 123", "phone", "plus 44 7700 900 123"),
        ("pay 4111 1111 1111 111 one now", "card", "4111 1111 1111 111 one"),
        ("four 111 1111 1111 111 one, 2 items", "card", "four 111 1111 1111 111 one"),
        ("john dot doe at example dot com", "email", "john dot doe at example dot com"),
        ("ask john[dot]doe[at]example[dot]com", "email", "john[dot]doe[at]example[dot]com"),
        ("ask john[.]doe@example[.]com", "email", "john[.]doe@example[.]com"),
        ("it is john dot doe at example.com", "email", "john dot doe at example.com"),
    ],
)
def test_few_spelled_parts(text, kind, found):
    assert [text[a:b] for a, b in pii.all_spans(text)[kind]] == [found]
    assert pii.masked(text) == text.replace(found, f"<{kind.upper()}>")


def test_spelled_dots_before_a_plain_address():
    text = "john dot a dot doe@example.com"
    assert set(pii.base_spans(text)["email"]) < set(pii.all_spans(text)["email"])
    assert pii.masked(text) == "<EMAIL>"


@pytest.mark.parametrize("text", ["version 1 dot 2 and one 3", "300 dot 1 dot 1 dot 1", "one 1234 5678 9012 3456", "two of 12, 15 and 20", "+44 seven 7"])
def test_numbers_no_detector_accepts_stay(text):
    assert pii.listed(pii.all_spans(text)) == "" and pii.masked(text) == text


@pytest.mark.parametrize("text", ["1 dot " * 200_000, "one, 1, " * 100_000, "a dot " * 200_000 + "b at c.d", "1" * 10**6 + " dot one 1", "a dot b at the.c " * 60_000, "[.]" * 300_000, "one 1 x " * 100_000])
def test_few_spelled_parts_are_linear(text):
    start = time.process_time()
    pii.all_spans(text)
    assert time.process_time() - start < 12
