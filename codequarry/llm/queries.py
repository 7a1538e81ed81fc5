"""One query per operator, with production parameters over whole tables, and their SQL."""

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch
from . import alignment, bpe, exact_dedup, langid, license_scan, packing, pii, quality, repeats, search, sharding, simhash, token_counts
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> bytes:
    """A tokenizer file, read on the driver."""
    return Path(public_tokenizers.path(name)).read_bytes()


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.membership(documents(spark, sf_dir))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.membership(documents(spark, sf_dir))


@query
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(documents(spark, sf_dir), source, public_tokenizers.PATTERN)


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts with an empty cache of its own, so every distinct text is encoded."""
    return token_counts.counts(
        documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), scratch(spark, "token-cache"), limit=512
    )


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), capacity=2048, seed=6)


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.places(documents(spark, sf_dir), shards=40, seed=20)


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return alignment.alignment(documents(spark, sf_dir), a, b)


@query
def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(documents(spark, sf_dir))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)
