import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from cases import awkward, bag, documents, empty, plain

from codequarry.llm import components, simhash


def fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if c < "\x80" else c for c in text)) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values):
    """Value -> smallest connected value, by all pairs."""
    values = sorted(set(values))
    parent = {v: v for v in values}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for k, a in enumerate(values):
        for b in values[:k]:
            if (a ^ b).bit_count() <= 3:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {v: top(v) for v in values}


def expected(rows):
    fps = [(i, fingerprint(t)) for i, t in rows]
    label = classes([f for _, f in fps])
    ids = defaultdict(list)
    for i, f in fps:
        ids[label[f]].append(i)
    smallest = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return [(i, f"{f:016x}", smallest[label[f]]) for i, f in fps]


def near(seed=1, n=60):
    """Texts, long enough for a changed word to change few bits."""
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for k in range(n // 6):
        text = [rnd.choice(words) for _ in range(400)]
        for _ in range(6):
            own = list(text)
            for _ in range(rnd.randint(0, 2)):
                own[rnd.randrange(len(own))] = "changed"
            out.append(" ".join(own))
    return list(enumerate(out))


def test_fingerprint():
    for _, t in [*near(2, 12), (0, "One two"), (0, ""), (0, " \n"), (0, "É é A b c d"), (0, "a b c")]:
        assert simhash.fingerprint(t) == fingerprint(t)


def test_blocks_of_shingles_add_up(monkeypatch):
    text = " ".join(f"w{k % 37}" for k in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 13)
    assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize("node_size", [2, 8, 2048])
def test_membership(spark, node_size):
    for docs in (
        awkward(spark),
        documents(spark),
        spark.createDataFrame(near(), "doc_id long, text string"),
    ):
        rows = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.membership(docs, node_size).collect()]
        assert bag(rows) == bag(expected(plain(docs)))


def test_near_copies_link(spark):
    docs = spark.createDataFrame(near(), "doc_id long, text string")
    found = Counter(r["component_id"] for r in simhash.membership(docs).collect())
    assert len(found) < 40


def gray(codes):
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


@pytest.mark.parametrize("seed", range(25))
def test_tree_join(seed, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 300))
    codes = rng.integers(0, 1 << 63, size=4, dtype=np.uint64)[rng.integers(0, 4, n)]
    for _ in range(int(rng.integers(0, 7))):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    group = np.sort(rng.integers(0, 3, n))
    order = np.lexsort((gray(codes), group))
    codes, group = codes[order], group[order]
    label = simhash.linked(group, codes)
    for g in range(3):
        own = np.flatnonzero(group == g)
        want = classes([int(c) for c in codes[own]])
        for a in own:
            for b in own:
                assert (label[a] == label[b]) == (want[int(codes[a])] == want[int(codes[b])])


def test_finer_masks_cover_the_open_bits():
    full = (1 << 64) - 1
    for mask in (0, (1 << 16) - 1, full ^ 0b111, full):
        masks = simhash.finer_masks(mask)
        union = 0
        for m in masks:
            assert m & mask == mask
            union |= m
        assert union == full
        # Three differing bits leave one of the quarters untouched.
        assert len(masks) == min(4, 1 + (64 - mask.bit_count())) or mask == full


def test_dense_node_is_refined(spark):
    rng = np.random.default_rng(3)
    codes = np.full(600, np.uint64(0x0123456789ABCDEF))
    for _ in range(4):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64))
    codes = np.unique(codes)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    want = classes([int(c) for c in codes])
    for size in (20, 10_000):
        edges = simhash.links(df, node_size=size)
        labels = {r["node"]: r["label"] for r in components.components(edges).collect()}
        signed = {int(c): int(c.view(np.int64)) for c in codes}
        groups = defaultdict(set)
        for c in want:
            groups[labels.get(signed[c], signed[c])].add(c)
        true = defaultdict(set)
        for c, top in want.items():
            true[top].add(c)
        assert bag(map(sorted, groups.values())) == bag(map(sorted, true.values()))


def test_components_of_a_long_chain(spark):
    rows = [(k, k + 1) for k in range(300)] + [(1000, 1001), (1002, 1001), (5, 5)]
    random.Random(1).shuffle(rows)
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(1, 301)} | {1001: 1000, 1002: 1000}


def test_survivors(spark):
    docs = awkward(spark)
    got = simhash.survivors(docs)
    assert got.columns == docs.columns
    rows = expected(plain(docs))
    by_class = defaultdict(list)
    label = classes([int(f, 16) for _, f, _ in rows])
    for i, f, _ in rows:
        by_class[label[int(f, 16)]].append(i)
    want = [min((i for i in v if i is not None), default=None) for v in by_class.values()]
    assert sorted(map(str, want)) == sorted(str(r["doc_id"]) for r in got.collect())


def test_empty(spark):
    assert simhash.membership(empty(spark)).collect() == []
    assert simhash.survivors(empty(spark)).collect() == []
