import zlib

import numpy as np
import pytest
from cases import awkward, documents, empty, plain
from pyspark.sql import functions as F

from codequarry.llm import langid

SAMPLE = {"en": "the cat sat on the mat and the dog ran far away", "fr": "le chat est sur la table et le chien court au loin"}


def phrases(models, text, training):
    """Greedy longest phrases found by substring search, block by block."""

    def letters(codes):
        return "".join(chr(64 + c) if c else "\0" for c in codes.tolist())

    source = letters(models.symbols[models._raw(training)])
    text, n = letters(models.coded(text)).replace("\0", "\1"), 0
    for a in range(0, len(text), langid.BLOCK):
        block, i = text[a : a + langid.BLOCK], 0
        while i < len(block):
            j = i + 1
            while j < len(block) and block[i : j + 1] in source:
                j += 1
            n, i = n + 1, j
    return n


def test_cross_parsing(monkeypatch):
    monkeypatch.setattr(langid, "LANES", 3)
    monkeypatch.setattr(langid, "BLOCK", 17)
    models = langid.Models(SAMPLE)
    for text in ["the dog sat far away on the mat", "le chien", "zzz the q le", "Ünknown ß letters", "THE CAT", "a" * 100]:
        symbols = models.coded(text)
        blocks = [symbols[a : a + 17] for a in range(0, len(symbols), 17)]
        got = models.phrases(blocks).sum(axis=0).tolist()
        assert got == [phrases(models, text, SAMPLE[lang]) for lang in models.languages]


def test_automaton_has_all_substrings_and_no_others():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 3, 60).tolist()
    step, n = langid._automaton(symbols)
    assert n == 60 and len(step) <= 2 * n
    subs = {tuple(symbols[a:b]) for a in range(60) for b in range(a + 1, min(60, a + 8) + 1)}
    for _ in range(3000):
        word = tuple(rng.integers(0, 3, rng.integers(1, 8)).tolist())
        state = 0
        for c in word:
            state = step[state].get(c) if state is not None else None
        assert (state is not None) == (word in subs)


def test_predict():
    models = langid.Models(SAMPLE)
    got = models.predict(["the cat and the dog", None, "", "123 !?", "le chat est au loin", "the cat and the dog"])
    assert [lang for lang, _ in got] == ["en", "und", "und", "und", "fr", "en"]
    assert got[0] == got[5] and all(0 <= s <= 1 for _, s in got) and got[1][1] == 0
    assert langid.Models({}).predict(["text"]) == [("und", 0.0)]
    assert langid.Models({"xx": "abc"}).predict(["text"]) == [("xx", 1.0)]
    # Equal evidence goes to the first name.
    assert langid.Models({"b": "same", "a": "same"}).predict(["same"])[0][0] == "a"


@pytest.mark.parametrize("source", [awkward, documents])
def test_identify(spark, source):
    docs = source(spark)
    rows = langid.identify(docs).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in plain(docs))
    learned = {r["lang"] for r in docs.select("lang").collect()} - {None}
    for r in rows:
        want = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == want
        assert r["lang_pred"] in learned | {"und"} and 0 <= r["score"] <= 1
    texts = dict(plain(docs))
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[r["doc_id"]])) for r in rows if r["doc_id"] is not None)


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97


def test_only_training_folds_and_no_other_columns_count(spark):
    docs = documents(spark)
    held = langid.fold() == 0
    before = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs).collect()}
    # Labels and sources of held-out rows, and sources anywhere, change nothing.
    changed = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    after = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(changed).collect()}
    assert before == after


def test_sample_is_bounded(spark):
    sample = langid.sample(documents(spark, "/root/testdata/sf0.01"), max_docs=5, max_chars=700)
    assert set(sample) == {"en", "fr", "de", "es"} and all(0 < len(t) <= 700 for t in sample.values())


def test_nothing_learned(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(docs).collect()} == {("und", 0.0)}
    assert langid.identify(empty(spark)).collect() == []


@pytest.mark.parametrize("junk", ["", "123", "ok", "merci ", "e t a o i n s r h l d u c m p f g"])
def test_tiny_samples_win_nothing(junk):
    text = "A dog and a cat sat far away from the man, and the rat ran on the mat."
    models = langid.Models({**SAMPLE, "junk": junk})
    assert [lang for lang, _ in models.predict([text, "Le chien est sur la table, le chat au loin."])] == ["en", "fr"]


def test_letterless_texts_take_no_place_in_the_sample(spark):
    # Ids of all folds; every language's first texts by the order of ids have no letter.
    rows = [(i, "" if i % 2 else "123", "en") for i in range(400)] + [(i, "the cat sat", "en") for i in range(400, 410)]
    rows += [(i, "42", "xx") for i in range(410, 420)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert "cat" in langid.sample(docs)["en"] and "xx" not in langid.sample(docs)


@pytest.mark.parametrize("columns", [2, 3, 7, 126])
def test_rare_letters_are_parsed_like_frequent_ones(monkeypatch, columns):
    monkeypatch.setattr(langid, "ALPHABET", columns)
    models = langid.Models({**SAMPLE, "zh": SCRIPTS["zh"][0]})
    for text in ["the dog sat far away on the mat", "le chien", "zzz the q le 我们今天去公园", "猫在桌子上 the cat", "a" * 100]:
        symbols = models.coded(text)
        blocks = [symbols[a : a + langid.BLOCK] for a in range(0, len(symbols), langid.BLOCK)]
        sources = [SAMPLE["en"], SAMPLE["fr"], SCRIPTS["zh"][0]]
        assert models.phrases(blocks).sum(axis=0).tolist() == [phrases(models, text, s) for s in sources]


# Text to learn from and text to tell.
SCRIPTS = {
    "zh": ("我们今天去公园散步,天气很好。猫在桌子上睡觉,狗在外面跑。他们明天要去学校学习中文。", "今天天气很好,我们去学校。"),
    "ja": ("私たちは今日公園へ散歩に行きます。猫は机の上で寝ています。犬は外で走っています。明日は学校で日本語を勉強します。", "今日は学校へ行きます。犬は寝ています。"),
    "ko": ("우리는 오늘 공원에 산책하러 갑니다. 고양이는 책상 위에서 자고 있습니다. 내일은 학교에서 한국어를 공부합니다.", "오늘은 학교에서 공부합니다. 고양이는 자고 있습니다."),
    "ru": ("мы сегодня идём гулять в парк, погода хорошая. кошка спит на столе, а собака бегает на улице. завтра мы пойдём в школу.", "собака спит на улице, а кошка на столе."),
    "el": ("σήμερα πάμε βόλτα στο πάρκο, ο καιρός είναι καλός. η γάτα κοιμάται στο τραπέζι και ο σκύλος τρέχει έξω.", "ο σκύλος κοιμάται στο πάρκο και η γάτα έξω."),
    "ar": ("نذهب اليوم إلى الحديقة والطقس جميل. القطة تنام على الطاولة والكلب يركض في الخارج. غدا نذهب إلى المدرسة.", "الكلب ينام في الحديقة والقطة على الطاولة."),
}


def test_scripts_side_by_side(spark):
    docs = documents(spark, "/root/testdata/sf0.01").where("lang is not null")
    learned = {**langid.sample(docs), **{lang: learn for lang, (learn, _) in SCRIPTS.items()}}
    models = langid.Models(learned)
    assert (models.coded("".join(t for _, t in SCRIPTS.values())) != 0).all()
    tell = {lang: text for lang, (_, text) in SCRIPTS.items()}
    for lang in ("en", "fr"):
        tell[lang] = learned[lang][1000:1200]
    assert {lang: models.predict([text])[0][0] for lang, text in tell.items()} == {lang: lang for lang in tell}
    scores = dict(zip(tell, (s for _, s in models.predict(list(tell.values())))))
    assert all(s > 0.05 for s in scores.values())


def test_sample_holds_one_row_of_an_id(spark):
    rows = [(7, f"copy {'x' * (i % 3)}", "en") for i in range(500)] + [(i, f"text of {i}", "en") for i in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").where(langid.fold() != 0)
    ids = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
    assert 7 in ids
    lines = langid.sample(docs)["en"].split("\n")
    assert sorted(lines) == sorted(["copy " if i == 7 else f"text of {i}" for i in ids])
    # An id's many rows take one place.
    assert len(langid.sample(docs, max_docs=5)["en"].split("\n")) == 5


def test_sample_shares_its_characters(spark):
    rows = [(i, chr(97 + i) * (100_000 if i < 20 else 10), "en") for i in range(26)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").where(langid.fold() != 0)
    kept = {r["doc_id"] for r in docs.collect()}
    sample = langid.sample(docs, max_chars=2000)["en"]
    counts = {i: sample.count(chr(97 + i)) for i in kept}
    long = [n for i, n in counts.items() if i < 20]
    assert len(sample) <= 2000 and max(long) - min(long) <= 1 and sum(counts.values()) > 1900
    assert all(n == 10 for i, n in counts.items() if i >= 20)
