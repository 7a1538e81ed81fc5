"""Repeated passages against a brute-force version over all strings of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest
from cases import LONG, awkward, documents, empty
from codequarry.llm import repeats
from pyspark.sql import functions as F


def brute(docs):
    """``docs``: (doc_id, place in the table, text)."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0, docs[i][1]))
    seen, out = set(), []
    for i in order:
        data = (docs[i][2] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - repeats.LENGTH + 1):
            s = data[k : k + repeats.LENGTH]
            if s in seen:
                gone[k : k + repeats.LENGTH] = True
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((docs[i][0], len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def known(df):
    return [tuple(r) for r in df.select("doc_id", F.monotonically_increasing_id(), "text").collect()]


def table(spark, texts, parts=3):
    return spark.createDataFrame([(i, t) for i, t in texts], "doc_id long, text string").repartition(parts)


@pytest.mark.parametrize("block", [1000, 60_000, repeats.BLOCK_BYTES])
def test_documents(spark, block):
    docs = documents(spark)
    assert rows(repeats.repeats(docs, block)) == brute(known(docs))


def test_awkward_documents(spark):
    docs = awkward(spark).withColumn("block", F.lit("x")).withColumn("row", F.lit(1))
    assert rows(repeats.repeats(docs)) == brute(known(docs))


def made(seed):
    """Texts out of a few shared passages, with edits, in a small alphabet or a large one."""
    rng = random.Random(seed)
    letters = rng.choice(["ab", "abcdefgh ", "aé😀", "a"])
    passages = ["".join(rng.choices(letters, k=rng.choice([50, 99, 100, 101, 147, 300]))) for _ in range(6)]
    texts = []
    for i in range(40):
        text = "".join(rng.choice([*passages, *rng.choices(letters, k=3)]) for _ in range(rng.randrange(5)))
        if rng.random() < 0.5 and text:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", "Z", letters]) + text[at + 1 :]
        texts.append((rng.choice([None, i, i, i, 7]), text))
    return texts


@pytest.mark.parametrize("seed", range(8))
def test_made_texts(spark, seed):
    docs = table(spark, made(seed))
    assert rows(repeats.repeats(docs, 700)) == brute(known(docs))


@pytest.mark.parametrize("seed", range(4))
def test_hot_cores_are_dealt_into_parts(spark, seed):
    docs = table(spark, made(seed) + [(100 + i, LONG[i : i + 400]) for i in range(30)])
    assert rows(repeats.repeats(docs, 700, group=3)) == brute(known(docs))


def test_a_third_is_one_text(spark):
    docs = table(spark, [(i, LONG[:700] if i % 3 else f"own {i} " * 40) for i in range(120)])
    result = repeats.repeats(docs, 2000)
    assert rows(result) == brute(known(docs))
    assert result.where("n_removed = n_bytes").count() == 79


def test_strings_meet_at_one_trigger():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 100, 5000).astype(np.uint8)
    data = np.concatenate([np.zeros(100, np.uint8), text, np.zeros(100, np.uint8)])
    at, first, last = repeats.triggers(data, np.array([100]), np.array([5100]))
    assert first[0] == 100 and last[-1] == 5000 and (first[1:] == last[:-1] + 1).all()
    assert ((first >= at - repeats.PLACES + 1) & (last <= at)).all() and len(at) < 5000 * 3 / 93


def test_empty(spark):
    assert repeats.repeats(empty(spark)).collect() == []
