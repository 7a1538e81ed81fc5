"""Leakage audit and statistics against brute force on small tables."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from codequarry.functions import hashing
from codequarry.operators import leakage, neardup, similarity, skew, stats


def words(s):
    return re.findall("[a-zA-Z0-9_]+", s)


def shingles(s):
    t = words(s)
    return {" ".join(t[i:i + 3]) for i in range(len(t) - 2)} if len(t) >= 3 else ({"".join(t)} if t else set())


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def corpus():
    """Rows in which one text and its near copies make up a third of every split."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(240):
        split = ("train", "train", "train", "test")[i % 4] if i % 9 else "validation"
        if i % 3 == 0:
            toks = list(base)
            for _ in range(i % 5):
                toks[rng.randrange(len(toks))] = rng.choice(vocabulary)
        else:
            toks = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 50))]
        function = " ".join(toks)
        rows.append((i, split, f"o/r{i % 6 if i % 2 else 0}" if i % 11 else "", " ".join(toks[:10]), function, None if i % 13 == 0 else f"h{i % 30}"))
    return rows


@pytest.fixture(scope="module")
def df(spark, corpus):
    schema = "id int, split string, nwo string, docstring string, function string, function_sha string"
    return spark.createDataFrame(corpus, schema)


def test_exact_overlap(df, corpus):
    sha = {s: {r[5] or "" for r in corpus if r[1] == s} for s in leakage.SPLITS}
    pair = {s: {(r[3].strip(), r[4].strip()) for r in corpus if r[1] == s} for s in leakage.SPLITS}
    got = {(r.split_a, r.split_b): (r.sha_overlap, r.pair_overlap) for r in leakage.exact_dup_overlap(df).collect()}
    assert got == {
        (a, b): (len(sha[a] & sha[b]), len(pair[a] & pair[b]))
        for a, b in (("train", "validation"), ("train", "test"), ("validation", "test"))
    }
    crossing = {r.function_sha: r.splits for r in leakage.cross_split_keys(df).collect()}
    assert crossing == {k: n for k in set.union(*sha.values()) if (n := sum(k in s for s in sha.values())) > 1}
    assert "" not in {r.function_sha for r in leakage.cross_split_keys(df, ignore_missing=True).collect()}


def test_missing_split(df):
    only = df.where("split <> 'validation'")
    got = {(r.split_a, r.split_b): r.overlap_repos for r in leakage.repo_contamination(only).collect()}
    assert got[("train", "validation")] == 0 and got[("train", "test")] > 0


def test_repositories(df, corpus):
    count = Counter((r[1], r[2]) for r in corpus)
    stat = {r.split: (r.repos, r.samples) for r in leakage.split_repo_stats(df).collect()}
    for s in leakage.SPLITS:
        assert stat[s] == (len({k[1] for k in count if k[0] == s and k[1]}), sum(n for k, n in count.items() if k[0] == s))
    top = leakage.top_overlap_repos(df, 2).where("split_a = 'train' and split_b = 'test'").orderBy("rank").collect()
    both = {n: count["train", n] + count["test", n] for _, n in count if n and count["train", n] and count["test", n]}
    assert [r.nwo for r in top] == sorted(both, key=lambda n: (-both[n], n))[:2]


def brute_fuzzy(corpus):
    side = {s: {r[3].lower().strip() for r in corpus if r[1] == s} - {""} for s in ("train", "test")}
    out = {}
    for t in side["test"]:
        best = min(((-jaccard(set(words(t)), set(words(d))), d) for d in side["train"] if words(d)), default=None)
        if words(t) and best and -best[0] >= 0.7:
            out[t] = (best[1], -best[0])
    return out, len(side["test"])


@pytest.mark.parametrize("frequent", [1, 8, 2048])
def test_similar_sets_misses_nothing(spark, corpus, frequent):
    sets = {r[0]: shingles(r[4]) for r in corpus}
    sides = {
        s: {frozenset(sets[r[0]]): r[0] for r in corpus if r[1] == s and sets[r[0]]} for s in ("train", "test")
    }
    frames = {
        s: spark.createDataFrame([(k, sorted(v)) for v, k in sides[s].items()], "key int, tokens array<string>") for s in sides
    }
    for t in (0.5, 0.8):
        got = {(r.left_key, r.right_key): r.similarity for r in similarity.similar_sets(frames["test"], frames["train"], t, frequent).collect()}
        want = {
            (b, a): jaccard(x, y) for y, b in sides["test"].items() for x, a in sides["train"].items() if jaccard(x, y) >= t
        }
        assert got == want and want


def test_similar_sets_with_hot_tokens_split(spark, corpus, monkeypatch):
    with_hot_keys_split(monkeypatch)
    test_similar_sets_misses_nothing(spark, corpus, 8)


def with_hot_keys_split(monkeypatch):
    """Keys that make more than one pair are cut into cells of one."""
    plain = skew.skew_join
    for module in (similarity, neardup):
        monkeypatch.setattr(module, "skew_join", lambda *args: plain(*args, side=1))


def test_near_duplicates_with_hot_keys_split(spark, df, corpus, monkeypatch):
    with_hot_keys_split(monkeypatch)
    test_near_duplicates(df, corpus)
    test_docstring_fuzzy(df, corpus)


def test_empty_side(spark):
    some = spark.createDataFrame([(1, ["a"])], "key int, tokens array<string>")
    assert similarity.similar_sets(some.where("key > 1"), some, 0.5).count() == 0
    assert similarity.similar_sets(some.where("key > 1"), some.where("key > 1"), 0.5).count() == 0


def test_docstring_fuzzy(df, corpus):
    want, total = brute_fuzzy(corpus)
    got = {r.test_docstring: (r.train_docstring, r.similarity) for r in similarity.docstring_fuzzy(df).collect()}
    assert got == want and want
    s = similarity.docstring_fuzzy_summary(df).first()
    assert (s.matched_07, s.unique_test) == (len(want), total)
    assert s.matched_09 == sum(v[1] >= 0.9 for v in want.values())


def test_docstring_exact(df, corpus):
    train = {r[3].strip().lower() for r in corpus if r[1] == "train"}
    test = [r[3].strip().lower() for r in corpus if r[1] == "test" and r[3].strip()]
    r = leakage.docstring_exact_overlap(df).first()
    assert (r.overlap, r.test_rows) == (sum(d in train for d in test), len(test))


def test_near_duplicates(df, corpus):
    """Rebuild signatures and bands row by row, without collapsing copies."""
    a, b = hashing.permutations()

    def signature(text):
        import hashlib

        h = [int(hashlib.md5(s.encode()).hexdigest()[:8], 16) % hashing.PRIME for s in shingles(text)]
        return [min((x * v + y) % hashing.PRIME for v in h) for x, y in zip(a, b)] if h else None

    sig = {r[0]: signature(r[4]) for r in corpus}
    rows = {s: [r[0] for r in corpus if r[1] == s and sig[r[0]]] for s in ("train", "test")}
    summary = {r.threshold: r for r in neardup.near_dup_summary(df).collect()}
    pairs = neardup.near_dup_pairs(df).collect()
    for t, (n, rows_per_band) in {0.5: (25, 5), 0.7: (14, 9), 0.8: (9, 13), 0.9: (5, 25)}.items():
        candidates = matched = total = 0
        for x in rows["test"]:
            near = [
                y for y in rows["train"]
                if any(sig[x][i * rows_per_band:(i + 1) * rows_per_band] == sig[y][i * rows_per_band:(i + 1) * rows_per_band] for i in range(n))
            ]
            close = [y for y in near if sum(p == q for p, q in zip(sig[x], sig[y])) / 128 >= t]
            candidates, matched, total = candidates + bool(near), matched + bool(close), total + len(close)
        s = summary[t]
        assert (s.candidate_rows, s.verified_rows, s.verified_pairs) == (candidates, matched, total)
        assert sum(r.test_rows * r.train_rows for r in pairs if r.threshold == t) == total
    assert summary[0.5].test_rows == sum(r[1] == "test" for r in corpus) and summary[0.5].verified_pairs > 0
    top = neardup.top_near_dups(df, n=3).collect()
    assert len(top) == 3 and top[0].similarity == 1.0


def test_any_threshold(df):
    assert [neardup.banding(t) for t in neardup.THRESHOLDS] == [(25, 5), (14, 9), (9, 13), (5, 25)]
    bands, rows = neardup.banding(0.6)
    assert bands * rows <= 128
    pairs = neardup.near_dup_pairs(df, thresholds=(0.6,)).collect()
    assert pairs and min(r.similarity for r in pairs) >= 0.6 and max(r.similarity for r in pairs) == 1.0


def test_best_match(df):
    pairs = neardup.near_dup_pairs(df, thresholds=(0.5,)).collect()
    want = {}
    for r in pairs:
        best = want.get(r.test_id)
        if best is None or (-r.similarity, r.train_id) < (-best.similarity, best.train_id):
            want[r.test_id] = r
    got = neardup.near_dup_best(df, threshold=0.5).collect()
    assert {(r.test_id, r.train_id, r.similarity) for r in got} == {(r.test_id, r.train_id, r.similarity) for r in want.values()}


def test_signatures_do_not_depend_on_blocks(monkeypatch):
    import pandas as pd

    batch = pd.Series([[5, 7, 11], None, [], list(range(1000)), [3], [hashing.PRIME - 1]])
    whole = hashing.signatures_of(batch)
    a, b = hashing.permutations()
    for h, s in zip(batch, whole):
        assert (s is None) == (not h)
        assert s is None or s.tolist() == [min((x * v + y) % hashing.PRIME for v in h) for x, y in zip(a, b)]
    monkeypatch.setattr(hashing, "_BLOCK", 3)
    again = hashing.signatures_of(batch)
    assert all((x is None and y is None) or x.tolist() == y.tolist() for x, y in zip(whole, again))


def test_near_dup_exact_counts_rows(df, corpus):
    want = sum(
        jaccard(shingles(x[4]), shingles(y[4])) >= 0.7
        for x in corpus if x[1] == "test" and words(x[4]) for y in corpus if y[1] == "train" and words(y[4])
    )
    got = neardup.near_dup_exact(df).agg(F.sum(F.col("test_rows") * F.col("train_rows"))).first()[0]
    assert got == want


def test_empty_functions_can_be_kept(spark):
    rows = [(1, "train", ""), (2, "train", " ;"), (3, "test", None), (4, "test", "a b c d"), (5, "train", "e f g h")]
    df = spark.createDataFrame(rows, "id int, split string, function string")
    assert neardup.near_dup_pairs(df).count() == 0
    pairs = neardup.near_dup_pairs(df, thresholds=(0.9,), keep_empty=True).collect()
    assert [(r.test_id, r.train_id, r.test_rows, r.train_rows, r.similarity) for r in pairs] == [(3, 1, 1, 2, 1.0)]
    summary = neardup.near_dup_summary(df, keep_empty=True).collect()
    assert {(r.candidate_rows, r.verified_pairs, r.test_rows, r.pct) for r in summary} == {(1, 2, 2, 50.0)}


def test_statistics(spark):
    rows = [(i, "x\n" * (i % 7), "d" * i, "#".join("ab" * i), "n" if i % 4 else "", "s" if i % 5 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, function string, docstring string, ast_function string, identifier string, source string")
    share = {r.source: (r.n, r.pct) for r in stats.shares(df, "source").collect()}
    assert share == {"s": (80, 100.0)}
    assert {r.has_identifier: r.n for r in stats.identifier_share(df).collect()} == {"Yes": 75, "No": 25}
    hist = stats.length_histogram(df, bins=10).where("measure = 'docstring_len'").orderBy("bin").collect()
    assert [r.n for r in hist] == [10] * 10 and hist[-1].bin == 9 and hist[1].bin_start == 9.9
    density = stats.length_density(df).where("measure = 'docstring_len'").orderBy("point").collect()
    sd = math.sqrt(sum((i - 49.5) ** 2 for i in range(100)) / 99)
    h = sd * 100 ** -0.2
    for r in (density[0], density[77], density[199]):
        x = r.point * 99 / 199
        want = sum(math.exp(-0.5 * ((x - i) / h) ** 2) for i in range(100)) / (100 * h * math.sqrt(2 * math.pi))
        assert abs(r.density - want) < 1e-12


def test_few_candidates_of_large_sets_and_none_lost(spark, monkeypatch):
    """Near copies share tokens all along their prefixes, strangers one or two of a common stock."""
    rng = random.Random(3)
    sets = []
    for i in range(60):
        base = rng.sample(range(3000), 150 + i)
        sets.append(base)
        for changed in (5, 20, 30):
            copy = list(base)
            copy[:changed] = [10_000 + i * 100 + k for k in range(changed)]
            sets.append(copy)
    keyed = [(f"k{i}", [f"t{x}" for x in dict.fromkeys(s)]) for i, s in enumerate(sets)]
    left, right = (spark.createDataFrame(keyed[k::2], "key string, tokens array<string>") for k in (0, 1))
    candidates, seen = similarity._candidates, []

    def counted(*args):
        out = candidates(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(similarity, "_candidates", counted)
    got = {(r.left_key, r.right_key) for r in similarity.similar_sets(left, right, 0.7).collect()}
    want = {(a, b) for a, s in keyed[::2] for b, r in keyed[1::2] if jaccard(set(s), set(r)) >= 0.7}
    assert got == want and len(want) > 100
    assert seen[0] <= 2 * len(want)


def test_best_match_by_search_in_cells(spark, monkeypatch):
    """Unlike docstrings, more than a cell takes on either side: no pairs join below the last bound."""
    rng = random.Random(5)
    rows = [(i, "test" if i % 3 == 0 else "train", " ".join(f"v{rng.randrange(200)}" for _ in range(rng.randrange(1, 30)))) for i in range(300)]
    rows += [(900, "test", "nothing like it"), (901, "validation", "v1 v2")]
    monkeypatch.setattr(similarity._searched, "__defaults__", (30, 40))
    bounds, join = [], similarity.similar_sets
    monkeypatch.setattr(similarity, "similar_sets", lambda a, b, t: bounds.append(t) or join(a, b, t))
    out = similarity.docstring_best(spark.createDataFrame(rows, "id int, split string, docstring string"), (0.7, 0.25))
    got = {r.test_docstring: (round(r.similarity, 9), r.train_docstring) for r in out.collect()}
    train = {d for _, s, d in rows if s == "train"}
    want = {}
    for d in {d for _, s, d in rows if s == "test"}:
        best = min((-jaccard(set(words(d)), set(words(t))), t) for t in train)
        want[d] = (round(-best[0], 9), best[1]) if best[0] < 0 else (0.0, None)
    assert got == want and min(bounds) > 0
