"""Near-duplicate queries over whole functions: what they write, and equal results however they are cut."""

import hashlib
import os
import random
import re

import numpy as np
import pytest

from codequarry.functions import hashing
from codequarry.operators import neardup, similarity
from codequarry.session import shared_dir

SCHEMA = "id int, split string, function string"


def shingles(s):
    t = re.findall("[a-zA-Z0-9_]+", s)
    return frozenset(" ".join(t[i:i + 3]) for i in range(len(t) - 2)) if len(t) >= 3 else frozenset({"".join(t)} if t else ())


def jaccard(a, b):
    return len(a & b) / len(a | b)


def brute(rows, threshold):
    """(test_id, train_id, test_rows, train_rows): similarity of distinct sets."""
    sides = {"test": {}, "train": {}}
    for i, split, text in rows:
        if split in sides and (s := shingles(text or "")):
            sides[split].setdefault(s, []).append(i)
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    return sorted(
        ((low(x), low(y), len(x), len(y), round(j, 9)) for a, x in sides["test"].items() for b, y in sides["train"].items() if (j := jaccard(a, b)) >= threshold),
        key=str,
    )


def got(df):
    return sorted(((r.test_id, r.train_id, r.test_rows, r.train_rows, round(r.similarity, 9)) for r in df.collect()), key=str)


def bytes_in(folder):
    folder = folder.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


@pytest.fixture(scope="module")
def unlike():
    """Long functions, two of them alike."""
    rng = random.Random(11)
    rows = [(i, ("test", "train", "train")[i % 3], " ".join(f"w{rng.randrange(5000)}" for _ in range(3000))) for i in range(120)]
    changed = rows[0][2].split(" ")
    changed[10] = "other"
    return [*rows, (900, "train", " ".join(changed))]


def written_by(spark, rows, query):
    before = bytes_in(shared_dir(spark))
    out = query(spark.createDataFrame(rows, SCHEMA)).collect()
    return out, (bytes_in(shared_dir(spark)) - before) / sum(len(r[2]) for r in rows)


def test_near_dup_exact_does_not_write_the_sets(spark, unlike):
    out, share = written_by(spark, unlike, neardup.near_dup_exact)
    assert [(r.test_id, r.train_id) for r in out] == [(0, 900)]
    assert share < 0.35


@pytest.fixture(scope="module")
def groups():
    """Groups of near copies, copies of rows, ids that repeat or are null, and functions of few words."""
    rng = random.Random(2)
    rows, splits = [], ("test", "train", "train", "validation")
    for g in range(12):
        base = [f"g{g}w{rng.randrange(80)}" for _ in range(60)]
        for c in range(g):
            text = list(base)
            for _ in range(c % 5):
                text[rng.randrange(60)] = rng.choice(["x", "y", f"w{rng.randrange(99)}"])
            rows += [(len(rows) % 70 if c % 4 else None, splits[c % 4], " ".join(text))] * (1 + c % 3)
    rows += [(300 + i, ("test", "train")[i % 2], t) for i, t in enumerate(["ab", "a b", "a  b", "a", None, "", "é", "a b c", "a b c a b c", "ab"])]
    return rows


@pytest.mark.parametrize("side", [500, 2])
def test_near_dup_exact_with_copies(spark, groups, monkeypatch, side):
    monkeypatch.setattr(similarity, "SIDE", side)
    df = spark.createDataFrame(groups, SCHEMA)
    want = brute(groups, 0.7)
    assert got(neardup.near_dup_exact(df)) == want and len(want) == 40


def test_near_dup_sure_does_not_write_the_sets(spark, unlike):
    out, share = written_by(spark, unlike, neardup.near_dup_sure)
    assert [(r.test_id, r.train_id) for r in out] == [(0, 900)]
    assert share < 0.15


@pytest.mark.parametrize("side", [500, 2])
def test_near_dup_sure_with_copies(spark, groups, monkeypatch, side):
    """The pairs that share a band, and no other pair of the cells they are compared in."""
    monkeypatch.setattr(similarity, "SIDE", side)
    df = spark.createDataFrame(groups, SCHEMA)
    exact = got(neardup.near_dup_exact(df, threshold=0.5))
    signed = {r.id: r.key for r in neardup._shingle_sets(df, "id", [(2, 64)]).select("id", "key").collect()}
    assert len(signed) == len({shingles(t or "") for _, s, t in groups if s != "validation"} - {frozenset()})
    found = got(neardup.near_dup_sure(df, threshold=0.5, recall=0.5))
    assert found and set(map(str, found)) < set(map(str, exact))


def test_near_dup_recall_does_not_write_the_sets(spark, unlike):
    out, share = written_by(spark, unlike, neardup.near_dup_recall)
    assert {(r.threshold, r.exact_pairs, r.found_pairs, r.recall) for r in out} == {(t, 1, 1, 1.0) for t in (0.7, 0.8, 0.9)}
    assert share < 0.5


def test_near_dup_recall_counts_exact_and_sure_pairs(spark, groups):
    df = spark.createDataFrame(groups, SCHEMA)
    got = {r.threshold: (r.exact_pairs, r.found_pairs) for r in neardup.near_dup_recall(df, thresholds=(0.5, 0.7), recall=0.5).collect()}
    assert got == {t: (len(brute(groups, t)), neardup.near_dup_sure(df, threshold=t, recall=0.5).count()) for t in (0.5, 0.7)}


@pytest.mark.parametrize("block", [1 << 22, 50])
def test_shingle_sets_are_those_of_the_words(monkeypatch, block):
    monkeypatch.setattr(hashing, "_TEXT", block)
    rng = random.Random(1)
    texts = ["", " ", "ab", "a b", "a", "a b c", "é a", "x" * 300 + " y z", "x" * 301 + " y z", "a b c a b c", " 1", *(f"{'y' * n} y {'z' * 25}" for n in range(20, 45)), "12345678 123456789 1 2"]
    texts += [" ".join(rng.choice(["a", "bb", "dddddddd", "eeeeeeeee", "é", "_"]) for _ in range(rng.randrange(30))) for _ in range(200)]
    values, ends = hashing.shingle_sets_of([t.encode() for t in texts])
    sets = [values[a:b] for a, b in zip(np.r_[0, ends[:-1]], ends)]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    for t, h in zip(texts, hashing.shingle_hashes_of([t.encode() for t in texts])):
        assert set(h) == {int(hashlib.md5(s.encode()).hexdigest()[:8], 16) % hashing.PRIME for s in shingles(t)}
    for a, x in zip(texts[::7], sets[::7]):
        for b, y in zip(texts, sets):
            assert len(np.intersect1d(x, y)) == len(shingles(a) & shingles(b))


def test_levels_tell_what_the_left_side_lacks(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "c"])], "key int, tokens array<string>")
    hashes = spark.sql("select xxhash64('a') a, xxhash64('b') b, xxhash64('c') c").first()
    for cells in (1, 8, 1 << 10, 1 << 27):
        levels = similarity.token_levels(df, cells)
        bits = len(levels).bit_length() - 1
        at = [int(hashing.mixed(np.array([h]).view(np.uint64))[0]) >> (64 - bits) for h in hashes]
        assert len(levels) <= cells and all(levels[at] >= [9, 1, 1])
        assert cells < 1 << 10 or (list(levels[at]) == [9, 1, 1] and (levels == 0).any())


def test_only_rounds_that_settle_most_sets_join(spark, monkeypatch):
    """Docstrings that resemble nothing go to the search after one round, alike ones before any other."""
    rng = random.Random(4)
    rows = [(i, ("test", "train")[i % 2], " ".join(f"w{rng.randrange(90)}" for _ in range(rng.randrange(1, 25)))) for i in range(200)]
    bounds, join = [], similarity.similar_sets
    monkeypatch.setattr(similarity, "similar_sets", lambda a, b, t: bounds.append(t) or join(a, b, t))
    out = similarity.docstring_best(spark.createDataFrame(rows, "id int, split string, docstring string")).collect()
    train = {d for _, s, d in rows if s == "train"}
    want = {}
    for d in {d for _, s, d in rows if s == "test"}:
        best = min((-jaccard(set(d.split()), set(t.split())), t) for t in train)
        want[d] = (round(-best[0], 9), best[1]) if best[0] < 0 else (0.0, None)
    assert {r.test_docstring: (round(r.similarity, 9), r.train_docstring) for r in out} == want
    assert bounds == [0.7]


def test_best_docstring_without_train_or_test(spark):
    rows = [(1, "test", "a b"), (2, "test", "c"), (3, "train", "d e f g"), (4, "train", "a")]
    df = spark.createDataFrame(rows, "id int, split string, docstring string")
    assert similarity.docstring_best(df.where("split = 'train'")).count() == 0
    for some, best in ((df, ("a", 0.5)), (df.where("id < 4"), (None, 0.0)), (df.where("split = 'test'"), (None, 0.0))):
        got = {r.test_docstring: (r.train_docstring, r.similarity) for r in similarity.docstring_best(some).collect()}
        assert got == {"a b": best, "c": (None, 0.0)}


@pytest.mark.parametrize("bound", [0.0, 0.2, 1 / 3, 0.5, 0.75, 1.0])
def test_index_finds_the_best_above_a_bound(bound):
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 15))) for _ in range(200)]
    index = similarity._Index(np.concatenate(sets[:120]), np.array([len(s) for s in sets[:120]]))
    for s in sets[100:]:
        s = rng.permutation(np.append(s, 99))
        each = np.array([len(np.intersect1d(s, r)) / len(np.union1d(s, r)) for r in sets[:120]])
        found = index.best(index.codes_of(s), bound)
        if each.max() < max(bound, 1e-9):
            assert found is None
        else:
            assert found[0] == each.max() and list(found[1]) == list(np.flatnonzero(each == each.max()))
