import hashlib
from collections import defaultdict

import pytest
from cases import awkward, bag, documents, empty, plain
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from codequarry.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    out, taken = [], set()
    for i, t in rows:
        keep = max((x for x in groups[t] if x is not None), default=None)
        kept = i == keep and t not in taken
        taken |= {t} if kept else set()
        out.append((i, keep, len(groups[t]), kept, hashlib.sha256(t.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("salts", [1, 3, 64])
@pytest.mark.parametrize("source", [awkward, documents])
def test_membership(spark, source, salts):
    docs = source(spark).repartition(5)
    got = [tuple(r) for r in exact_dedup.membership(docs, salts).collect()]
    assert bag(got) == bag(expected(plain(docs)))


def test_one_row_stays_of_each_text(spark):
    docs = awkward(spark)
    got = exact_dedup.survivors(docs)
    assert got.columns == docs.columns
    want = {(keep, digest) for _, keep, _, _, digest in expected(plain(docs))}
    rows = got.collect()
    assert len(rows) == len(want)
    assert {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in rows} == want
    # A text keeps its own row's other columns.
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in rows)


def test_empty(spark):
    assert exact_dedup.membership(empty(spark)).collect() == []
    assert exact_dedup.survivors(empty(spark)).collect() == []


def test_equal_digests_of_different_texts_never_merge(spark):
    with pytest.raises(PySparkException, match="different texts"):
        exact_dedup.membership(awkward(spark), digest=lambda text: F.lit("same")).collect()


def test_large_group_leaves_each_task_as_one_row(spark):
    docs = spark.range(20_000, numPartitions=8).select(F.col("id").alias("doc_id"), F.lit("copy").alias("text"))
    salted = exact_dedup._combined(
        docs.withColumn("digest", exact_dedup.sha256(F.col("text"))), F.max("doc_id"), salts=4
    )
    assert salted.count() == 4
    rows = exact_dedup.membership(docs).groupBy("keep_id", "group_size", "kept").count().collect()
    assert sorted(map(tuple, rows)) == [(19_999, 20_000, False, 19_999), (19_999, 20_000, True, 1)]


def test_many_identical_rows(spark):
    docs = spark.range(150_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = exact_dedup.membership(docs).groupBy("kept", "group_size").count().collect()
    assert sorted(map(tuple, rows)) == [(False, 150_000, 149_999), (True, 150_000, 1)]


def test_rows_equal_in_id_and_text_have_a_rule(spark):
    rows = [(1, "same", c) for c in "abcdef"]
    schema = "doc_id long, text string, lang string"
    kept = {tuple(exact_dedup.survivors(spark.createDataFrame(r, schema).repartition(3)).first()) for r in (rows, rows[::-1], rows[3:] + rows[:3])}
    assert len(kept) == 1
