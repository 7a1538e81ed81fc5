"""BPE, token counts and packing, against the libraries."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from cases import awkward, bag, documents, empty, plain
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from codequarry.llm import bpe, encoders, packing, pretokens, token_counts
from codequarry.llm.queries import tokenizer_file

JSON = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
TRICKY = st.lists(st.sampled_from(list(" \n\t\r\u0085 　\x1c'stremvldaZ19.!é中٣") + ["<|endoftext|>"]), max_size=14).map("".join)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(JSON))


@pytest.fixture(scope="module")
def encoder():
    return encoders.from_json(tokenizer_file(JSON))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(tokenizer_file(RANKS)), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(public_tokenizers.path(RANKS)).open("rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_known_one():
    assert public_tokenizers.PATTERN == pretokens.PATTERN


@settings(max_examples=2000, deadline=None)
@given(TRICKY)
def test_split(text):
    assert pretokens.split(text) == regex.findall(pretokens.PATTERN, text)


@settings(max_examples=800, deadline=None)
@given(text=TRICKY)
def test_piece_encoder(text, encoder, library):
    assert isinstance(encoder, encoders.PieceEncoder)
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_go_through_the_library():
    source = tokenizer_file("word_bpe_49k.json")
    other = encoders.from_json(source)
    assert isinstance(other, encoders.LibraryEncoder)
    want = Tokenizer.from_str(source.decode()).encode("Some words!", add_special_tokens=False).ids
    assert np.frombuffer(other.ids("Some words!"), "<u4").tolist() == want


@settings(max_examples=800, deadline=None)
@given(text=TRICKY)
def test_bpe_as_the_library(text, codec, reference):
    ids = codec.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(data=st.binary(max_size=60), more=st.binary(max_size=20), seed=st.integers(0, 1 << 20))
def test_prefix_table(data, more, seed, codec):
    v = codec.vocabulary
    rnd = random.Random(seed)

    def merged(b):
        return [v.ranks[p] for p in bpe.merged(b, v.ranks)]

    table = bpe.PrefixTable(v, data)
    assert table.ids() == merged(data)
    before = list(table.last)
    table.append(more)
    assert table.ids() == merged(data + more) and table.last[: len(before)] == before
    whole = data + more
    a = rnd.randint(0, len(whole))
    b = rnd.randint(a, len(whole))
    table.replace(a, b, data[:3])
    edited = whole[:a] + data[:3] + whole[b:]
    assert table.data == edited and table.last == bpe.PrefixTable(v, edited).last


def test_edit_stays_near(codec):
    table = bpe.PrefixTable(codec.vocabulary, b"the old harbour wall and the sea " * 500)
    assert table.replace(100, 103, b"xyz") < 400


def test_each_prefix_has_its_own_last_token(codec):
    v, data = codec.vocabulary, "überall strengthening 12345".encode()
    table = bpe.PrefixTable(v, data)
    assert table.last == [v.ranks[bpe.merged(data[:k], v.ranks)[-1]] for k in range(1, len(data) + 1)]


@pytest.mark.parametrize("source", [awkward, documents])
def test_round_trip(spark, source, reference):
    docs = source(spark)
    want = []
    for i, t in plain(docs):
        ids = reference.encode_ordinary(t) if len(t) < 250_000 or " " in t else None
        if ids is not None:
            digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            want.append((i, len(ids), digest, hashlib.sha256(t.encode()).hexdigest()))
    rows = bpe.digests(docs, tokenizer_file(RANKS), public_tokenizers.PATTERN).collect()
    got = [tuple(r) for r in rows if r["doc_id"] != 9 or source is documents]
    assert bag(got) == bag(want)
    if source is awkward:
        (long,) = [r for r in rows if r["doc_id"] == 9]
        assert long["decoded_sha256"] == hashlib.sha256(b"x" * 300_000).hexdigest()


def test_ids_and_back(spark):
    args = tokenizer_file(RANKS), public_tokenizers.PATTERN
    docs = awkward(spark)
    back = bpe.decode(bpe.encode(docs, *args), *args).collect()
    assert bag((r["doc_id"], bytes(r["content"])) for r in back) == bag((i, t.encode()) for i, t in plain(docs))
    assert bpe.digests(empty(spark), *args).collect() == []


@pytest.mark.parametrize("source", [awkward, documents])
def test_counts(spark, source, library, tmp_path):
    docs = source(spark)
    want = []
    for i, t in plain(docs):
        n = len(library.encode(t, add_special_tokens=False).ids)
        want.append((i, len(t.encode()), n, n > 512))
    got = token_counts.counts(docs, tokenizer_file(JSON), str(tmp_path / "cache"))
    assert bag(map(tuple, got.collect())) == bag(want)


def test_cache_is_used_and_grows(spark, tmp_path):
    cache, source = str(tmp_path / "cache"), tokenizer_file(JSON)
    docs = documents(spark)
    some = docs.where("doc_id % 2 = 0")
    token_counts.counts(some, source, cache).collect()
    first = spark.read.parquet(cache).count()
    assert first == some.select("text").distinct().count()
    # A count planted in the cache comes back: known digests are not encoded again.
    version = token_counts.version_of(source)
    planted = hashlib.sha256(b"planted").hexdigest()
    spark.createDataFrame([(planted, 7, 99, version)], token_counts.CACHE_SCHEMA).write.mode("append").partitionBy(
        "version"
    ).parquet(cache)
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(-1, "planted")], "doc_id long, text string"))
    rows = {r["doc_id"]: r["n_tokens"] for r in token_counts.counts(more, source, cache).collect()}
    assert rows[-1] == 99 and len(rows) == docs.count() + 1
    assert spark.read.parquet(cache).count() == docs.select("text").distinct().count() + 1
    known = token_counts.read_cache(spark, cache, version)
    assert token_counts.missing(more, known).count() == 0
    # Another version of the tokenizer meets none of it.
    assert token_counts.read_cache(spark, cache, "other").count() == 0


def test_doubled_cache_rows_count_once(spark, tmp_path):
    cache, source = str(tmp_path / "cache"), tokenizer_file(JSON)
    docs = awkward(spark)
    one = bag(map(tuple, token_counts.counts(docs, source, cache).collect()))
    rows = spark.read.schema(token_counts.CACHE_SCHEMA).parquet(cache).collect()
    rows = spark.createDataFrame(rows, token_counts.CACHE_SCHEMA)
    rows.write.mode("append").partitionBy("version").parquet(cache)
    assert bag(map(tuple, token_counts.counts(docs, source, cache).collect())) == one


def test_no_documents_no_cache_rows(spark, tmp_path):
    assert token_counts.counts(empty(spark), tokenizer_file(JSON), str(tmp_path / "cache")).collect() == []


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]


def check_packing(rows, docs, library, capacity):
    ids = defaultdict(list)
    for i, t in plain(docs):
        own = [*library.encode(t, add_special_tokens=False).ids, 0]
        for k, (a, n) in enumerate(packing.cut(len(own), capacity)):
            ids[i].append((k, a, n, zlib.crc32(np.array(own[a : a + n], "<u4").tobytes())))
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in ids.items()}
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(held)


@pytest.mark.parametrize("source", [awkward, documents])
def test_pack(spark, source, library):
    docs = source(spark)
    rows = packing.pack(docs, tokenizer_file(JSON)).collect()
    n = check_packing(rows, docs, library, packing.CAPACITY)
    total = sum(r["length"] for r in rows)
    assert n <= -(-total // packing.CAPACITY) + 2


def test_small_blocks_pack_as_well(spark, library):
    docs = documents(spark)
    rows = packing.pack(docs, tokenizer_file(JSON), block_items=16, islands=3, rounds=3).collect()
    n = check_packing(rows, docs, library, packing.CAPACITY)
    total = sum(r["length"] for r in rows)
    assert n <= -(-total // packing.CAPACITY) * 1.02 + 1


def test_pack_nothing(spark):
    assert packing.pack(empty(spark), tokenizer_file(JSON)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=80), st.integers(0, 99))
def test_evolved_bins(lengths, seed):
    population = packing.evolved(lengths, [], seed, 100)
    first = packing.best_fit([], sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 100)
    for bins in population:
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in bins)
    assert len(population[0]) <= len(first)
    child = packing.crossover(population[0], population[-1], lengths, 100, random.Random(seed))
    assert sorted(i for b in child for i in b) == list(range(len(lengths)))


def test_crossover_can_beat_best_fit():
    # Longest-first best fit needs one bin more than there has to be.
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    least = -(-sum(lengths) // 61)
    first = packing.best_fit([], sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 61)
    best = min(len(packing.evolved(lengths, [], seed, 61, generations=60)[0]) for seed in range(5))
    assert least <= best <= len(first)
