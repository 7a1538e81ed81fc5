"""Exact deduplication by skew-safe combining, native.

Copies are combined in three steps, each grouping on the SHA-256 digest *and* the whole text, so
rows only ever merge when their full content is equal: within a task (Spark's partial aggregation),
within a salt (a share of the tasks), and between the salts. A group of copies that holds a third
of all rows leaves each task as one row, and no task combines more than its salt's share of them.

Defined results: a null text counts as empty; a group whose ids are all null has a null
``keep_id``; of rows that agree in id and text, one is kept; an empty table gives an empty result;
other columns of the input never matter. Two different texts with one digest (none are known for
SHA-256) raise an error instead of being merged.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import repeated, texts, whole_text

# Shares the tasks are dealt into for the middle step. With T tasks a hot text reaches a task of
# that step in T / SALTS rows, and the last step in SALTS rows.
SALTS = 64


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _combined(rows: DataFrame, best: Column, salts: int) -> DataFrame:
    """(digest, text, best, n) of each distinct text; rows have digest, text and what best needs."""
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "text", "salt")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    )
    return salted


def groups(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per distinct text: digest, text, keep_id (largest id), group_size."""
    rows = texts(docs).withColumn("digest", digest(F.col("text")))
    salted = _combined(rows, F.max("doc_id"), salts)
    return salted.groupBy("digest", "text").agg(
        F.max("best").alias("keep_id"), F.sum("n").alias("group_size")
    )


def membership(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Only ids, digests and lengths move here besides the two text shuffles of ``groups``. The join
    keys on digest and length, so both sides are dealt out for it and adaptive execution can split
    the partition of a hot digest; rows that agree in all columns travel as one with their count.
    """
    winners = (
        groups(docs, salts, digest)
        .select("digest", F.octet_length("text").alias("n_bytes"), "keep_id", "group_size")
        .groupBy("digest")
        .agg(
            F.max("n_bytes").alias("n_bytes"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.count(F.lit(1)).alias("contents"),
        )
        .withColumn(
            "group_size",
            F.when(F.col("contents") == 1, F.col("group_size")).otherwise(
                F.raise_error(F.concat(F.lit("different texts with digest "), "digest")).cast("long")
            ),
        )
        .drop("contents")
    )
    members = (
        texts(docs)
        .select("doc_id", digest(F.col("text")).alias("digest"), F.octet_length("text").alias("n_bytes"))
        .groupBy("doc_id", "digest", "n_bytes")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    joined = repeated(members.join(winners, ["digest", "n_bytes"]), "copies")
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def survivors(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The documents that stay, with all their columns.

    The rest of a row travels with its text through the same two steps. Of rows that agree in text
    and id, the one stays whose other columns have the largest hash, so runs agree.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rank = F.struct(F.coalesce(F.col("rest.doc_id").cast("long"), F.lit(-(1 << 63))), F.xxhash64(F.to_json("rest")))
    rows = docs.select(
        sha256(whole_text()).alias("digest"),
        whole_text().alias("text"),
        F.struct(*others, F.col("text").isNull().alias("_null_text")).alias("rest"),
    )
    salted = _combined(rows, F.max_by("rest", rank), salts).withColumnRenamed("best", "rest")
    best = salted.groupBy("digest", "text").agg(F.max_by("rest", rank).alias("rest"))
    back = F.when(~F.col("rest._null_text"), F.col("text")).alias("text")
    return best.select(*[back if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
