import random
import re
from collections import Counter

import pytest
from cases import SF, awkward, bag, documents, empty, plain
from pyspark.sql import functions as F

from codequarry.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_repeated_words():
    rnd = random.Random(1)
    for _ in range(500):
        words = [rnd.choice([b"a", b"b", b"c"][: rnd.randint(1, 3)]) for _ in range(rnd.randint(0, 60))]
        assert quality.repeated_words(words) == brute(b" ".join(words).decode())[4]


def test_colliding_keys_are_compared(monkeypatch):
    words = [b"%d" % (k % 20) for k in range(60)]
    true = quality.repeated_words(words)
    monkeypatch.setattr(quality.np, "cumprod", lambda a: a * 0)
    assert quality.repeated_words(words) == true
    assert quality.repeated_words([b"%d" % k for k in range(59)] + [b"1"]) == 0


@pytest.mark.parametrize("source", [awkward, documents])
def test_judge(spark, source):
    docs = source(spark)
    rows = quality.judge(docs).collect()
    want = []
    for i, t in plain(docs):
        f = brute(t)
        want.append((i, *f, f[0] < 20 or 100 * f[4] > 30 * f[0]))
    assert bag(tuple(r)[:7] for r in rows) == bag(want)
    assert all(r["kept"] == (not r["base_failed"] and r["p_good"] >= 0.5) for r in rows)
    assert all(0 <= r["p_good"] <= 1 for r in rows)


def test_verdict_against_labels(spark):
    """Labels are never read by the fit; they only tell how good the verdict is."""
    sf = "/root/testdata/sf0.01"
    rows = quality.judge(documents(spark, sf)).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    bad = [r for r in rows if r["quality"] == 0]
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    assert sum(not r["kept"] for r in bad) >= 0.95 * len(bad) > 0
    assert sum(r["kept"] for r in good) >= 0.99 * len(good) > 0


def pattern(votes):
    n = 0
    for v in votes:
        n = n * 3 + v
    return n


def test_expectation_maximisation_finds_the_classes():
    """Rules of known accuracy on made votes: the fit has to tell good from bad."""
    rnd = random.Random(4)
    rates = [(0.6, 0.02), (0.5, 0.01), (0.4, 0.02), (0.3, 0.01)]
    counts, truth = Counter(), Counter()
    for _ in range(20_000):
        bad = rnd.random() < 0.2
        votes = [2 if rnd.random() < r[not bad] else 0 for r in rates]
        votes += [1 if rnd.random() < (0.3 if bad else 0.9) else 0 for _ in range(2)]
        counts[pattern(votes)] += 1
        truth[pattern(votes), bad] += 1
    p = quality.posteriors(counts, n_rules=6)
    right = sum(truth[k, False] if p[k] >= 0.5 else truth[k, True] for k in counts)
    assert right / 20_000 > 0.95
    assert quality.posteriors({}) == {}
    # One pattern alone keeps its sense.
    clean = pattern([1, 0, 0, 0, 0, 0, 0, 1])
    assert quality.posteriors({clean: 10})[clean] > 0.5


def test_votes_are_base_three(spark):
    docs = awkward(spark)
    got = quality.features(docs).select(quality.votes().alias("p")).collect()
    assert all(0 <= r["p"] < 3 ** len(quality.RULES) for r in got)


def test_passed_is_what_judge_keeps(spark):
    for docs in (documents(spark), awkward(spark)):
        got = quality.passed(docs)
        assert got.columns == docs.columns
        kept = quality.judge(docs).where("kept").select("doc_id").collect()
        assert bag(r["doc_id"] for r in got.collect()) == bag(r["doc_id"] for r in kept)
        whole = {(i, t) for i, t in plain(docs)}
        assert all((r["doc_id"], r["text"]) in whole for r in got.collect())


def test_empty(spark):
    assert quality.judge(empty(spark)).collect() == []
    assert quality.passed(empty(spark)).collect() == []


def test_clean_documents_stay_next_to_any_junk(spark):
    clean = documents(spark, SF).limit(150).select("doc_id", "text")
    junk = spark.range(400).select(
        (F.col("id") + 10_000).alias("doc_id"), F.concat(F.lit("### "), F.repeat(F.lit("buy!!! $$$ now ### "), 30)).alias("text")
    )
    alone = {r["doc_id"] for r in quality.judge(clean).where("kept").collect()}
    mixed = {r["doc_id"] for r in quality.judge(clean.union(junk)).where("kept").collect()}
    assert len(alone - mixed) <= 0.02 * len(alone) and not any(i >= 10_000 for i in mixed)
