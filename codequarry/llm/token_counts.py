"""Token counts through a digest cache.

The cache is a Parquet folder of counts by (tokenizer version, content digest). A run joins the
documents' digests to it, encodes one carrier text of each digest it lacks, appends those counts
and answers every document from the cache. The version digests the tokenizer file and how it is
called, so another tokenizer never meets these counts.

Only ids, digests and lengths are joined, but for one step: a missing digest's carrier (its
smallest id) is looked up with its text by (digest, id), a key no group of copies can make hot.

Defined results: a null text counts as empty (0 bytes, 0 tokens); rows may repeat; null ids are
fine; an empty table gives an empty result and appends nothing; other columns never matter. Runs
that append the same digest at the same time leave equal rows, which count once.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from . import encoders
from .common import per_batch, texts

CACHE_SCHEMA = "digest string, n_bytes long, n_tokens long, version string"
# How the library is called; part of the version.
OPTIONS = "add_special_tokens=False,truncation=None,padding=None"


def version_of(source: bytes) -> str:
    return hashlib.sha256(source + OPTIONS.encode()).hexdigest()


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_bytes, n_tokens) of this version, once each."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return (
        rows.where(F.col("version") == version)
        .groupBy("digest")
        .agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens"))
    )


def _digested(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", F.sha2("text", 256).alias("digest"), "text")


def missing(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(digest, text) of the digests that ``known`` lacks; a text is there more than once only if
    rows repeat with their id."""
    rows = _digested(docs)
    carriers = (
        rows.groupBy("digest")
        .agg(F.min("doc_id").alias("carrier"))
        .join(known.select("digest"), "digest", "left_anti")
    )
    own = (rows["digest"] == carriers["digest"]) & rows["doc_id"].eqNullSafe(carriers["carrier"])
    return rows.join(carriers, own, "left_semi").select("digest", "text")


def encoded(rows: DataFrame, source: bytes) -> DataFrame:
    """(digest, n_bytes, n_tokens) of (digest, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(source)  # the tokenizer file, a few MiB at most
    version = version_of(source)

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        encoder = encoders.loaded(version, shared.value)
        content = part.column("text").to_pylist()
        n_tokens = np.fromiter((len(encoder.ids(t)) // encoders.WIDTH for t in content), np.int64, len(content))
        return pa.RecordBatch.from_arrays(
            [part.column("digest"), pa.array((len(t.encode()) for t in content), pa.int64()), pa.array(n_tokens)],
            names=["digest", "n_bytes", "n_tokens"],
        )

    return per_batch(rows, batch, "digest string, n_bytes long, n_tokens long")


def update(docs: DataFrame, source: bytes, cache: str) -> DataFrame:
    """Append the counts that the cache lacks for ``docs``; returns the cache for this version."""
    spark, version = docs.sparkSession, version_of(source)
    new = encoded(missing(docs, read_cache(spark, cache, version)), source)
    new.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(cache)
    return read_cache(spark, cache, version)


def counts(docs: DataFrame, source: bytes, cache: str, limit: int = 512) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    The join has digest and length as key, so both sides are dealt out for it and adaptive
    execution can split a hot digest's partition.
    """
    known = update(docs, source, cache)
    rows = _digested(docs).select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.join(known, ["digest", "n_bytes"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
