"""Ranked search against a brute-force version of the contract."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from cases import SF, awkward, documents, empty
from codequarry.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    N, L = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * N) // max(L, 1)
            s = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                    s += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, d is not None, d or 0))
        out += [(item, r + 1, d if there else None, -s) for r, (s, there, d) in enumerate(sorted(scored)[:k])]
    return sorted(map(repr, out))


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def pairs(df):
    return [tuple(r) for r in df.select(df.columns[0], "text").collect()]


@pytest.mark.parametrize("shard,query", [(1, 1 << 20), (20_000, 2_000), (search.SHARD_BYTES, search.QUERY_BYTES)])
def test_ranking(spark, shard, query):
    docs = documents(spark).repartition(3)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(25)
    assert rows(search.ranked(docs, items, 10, shard, query)) == brute(pairs(docs.select("doc_id", "text")), pairs(items.select("item_id", "text")))


def test_awkward_documents_and_items(spark):
    docs = awkward(spark)
    items = spark.createDataFrame(
        [(1, "The QUICK fox fox"), (1, "The QUICK fox fox"), (2, None), (None, "mit license"), (3, ""), (4, "café 日本語 negative ids"), (5, "nothingofthekind"), (6, "the " * 500)],
        "item_id long, text string",
    )
    assert rows(search.ranked(docs, items)) == brute(pairs(docs.select("doc_id", "text")), pairs(items.select("item_id", "text")))


def test_ties_at_the_last_rank_go_by_id(spark):
    docs = spark.createDataFrame([(i, "alpha beta" if i % 2 else "alpha gamma") for i in range(60)], "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    assert [r["doc_id"] for r in search.ranked(docs, items).orderBy("rank").collect()] == [*range(1, 20, 2)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search.ranked(documents(spark), none).collect() == search.ranked(empty(spark), some).collect() == []


def test_it_stops_early_and_no_sooner_than_it_may():
    """One document leads both lists by far: a few positions are read, not the lists."""
    rng = np.random.default_rng(1)
    texts = [" ".join(["x"] * int(rng.integers(1, 4)) + ["pad"] * int(rng.integers(200, 400))) for _ in range(2000)]
    texts += ["x " * 50 + "y " * 50] * 3 + ["y " + "pad " * 300] * 500
    number = {b"x": 0, b"y": 1}
    shard = search.Shard(texts, number, np.array([700, 900]), len(texts), sum(map(len, map(search.terms_of, texts))))
    rank = np.arange(len(texts))
    best, scores, read = shard.best(np.array([0, 1]), np.array([1, 1]), 2, rank)
    assert best.tolist() == [2000, 2001] and read < 200
    every, _, read_all = shard.best(np.array([0, 1]), np.array([1, 1]), len(texts), rank)
    assert len(every) == len(texts) and read_all == 2003 + 503
