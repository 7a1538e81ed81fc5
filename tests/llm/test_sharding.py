import zlib
from collections import Counter, defaultdict

import pytest
from cases import awkward, documents, empty, plain
from pyspark.sql import functions as F

from codequarry.llm import sharding


@pytest.mark.parametrize("source", [awkward, documents])
@pytest.mark.parametrize("bucket_bytes", [2_000, 1 << 24])
def test_places(spark, source, bucket_bytes):
    docs = source(spark)
    rows = sharding.places(docs, shards=7, seed=5, bucket_bytes=bucket_bytes).collect()
    want = Counter((i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in plain(docs))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(k, [])) for k in range(7)]
    assert max(counts) - min(counts) <= 1
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}


def test_records_are_whole_and_mixed(spark):
    docs = documents(spark)
    rows = sharding.sharded(docs, shards=1, seed=1, bucket_bytes=1 << 30).orderBy("slot").collect()
    ids = [r["record"]["doc_id"] for r in rows]
    assert sorted(ids) == sorted(i for i, _ in plain(docs))
    texts = dict(plain(docs))
    assert all(r["record"]["text"] == texts[r["record"]["doc_id"]] for r in rows)
    # A shuffled order: neither the ids' nor the scattering hash's.
    assert sum(a < b for a, b in zip(ids, ids[1:])) in range(len(ids) // 3, 2 * len(ids) // 3)
    other = sharding.sharded(docs, shards=1, seed=2, bucket_bytes=1 << 30).orderBy("slot").collect()
    assert [r["record"]["doc_id"] for r in other] != ids


def test_buckets_are_near_their_size(spark):
    docs = documents(spark)
    size = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0]
    placed, n = sharding.buckets(docs, seed=3, bucket_bytes=size // 10)
    assert n == 11 or n == 10
    counts = [r["count"] for r in placed.groupBy("bucket").count().collect()]
    assert len(counts) == n and max(counts) < 4 * sum(counts) / n


def test_equal_rows_spread(spark):
    """A third of the rows agree in id and text."""
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).otherwise("x" * 500).alias("text")
    )
    placed, n = sharding.buckets(docs, seed=3, bucket_bytes=20_000)
    counts = [r["count"] for r in placed.groupBy("bucket").count().collect()]
    assert n > 20 and len(counts) == n and max(counts) < 3 * 3000 / n


def test_one_bucket_at_a_time_keeps_the_setting(spark):
    key = sharding._SIDE_BY_SIDE
    before = spark.conf.get(key, None)
    assert sharding.places(documents(spark), bucket_bytes=5_000).count() == documents(spark).count()
    assert spark.conf.get(key, None) == before


def test_empty(spark):
    assert sharding.places(empty(spark)).collect() == []


def test_written_shards(spark, tmp_path):
    docs = awkward(spark)
    sharding.write_shards(docs, str(tmp_path / "out"), shards=3, seed=9)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    assert {r["shard"] for r in back.select("shard").collect()} == {0, 1, 2}
    assert back.select("record.*").columns == docs.columns
    whole = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert {(r["doc_id"], r["text"]) for r in back.select("record.*").collect()} == whole
