"""The training-data pipeline over ``documents``: five stages, each on all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``; the last
returns packed pieces. The stages need no other table, so ``sf_dir`` is only there to be passed.
"""

from pyspark.sql import DataFrame, SparkSession

from codequarry.llm import exact_dedup, packing, pii, quality, simhash
from codequarry.llm.common import documents
from codequarry.llm.queries import tokenizer_file
from codequarry.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality verdict rejects go."""
    return quality.passed(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.survivors(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by close fingerprints the document with the smallest id stays."""
    return simhash.survivors(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is masked."""
    return pii.redacted(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' tokens in sequences of at most 2048."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=2048, seed=6)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("pii", personal_data),
    ("best-fit packing", packed_sequences),
]

# SimHash components, the fitted quality verdict and the packing are not SQL: tests/llm compares the
# stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, "stage")
    return docs
