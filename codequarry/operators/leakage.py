"""Exact leakage between dataset splits, and repository contamination."""

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import pair_key
from ..functions.text import normalize

SPLITS = ("train", "validation", "test")


def load_splits(parts: dict[str, DataFrame]) -> DataFrame:
    """One DataFrame with a split column; splits that do not exist are simply not in ``parts``."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def _present(split: str):
    return F.max(F.when(F.col("split") == split, 1).otherwise(0)).alias(f"in_{split}")


def keys_by_split(df: DataFrame, key) -> DataFrame:
    """One row per key with a 0/1 flag per split; flags combine before the shuffle."""
    return df.groupBy(key.alias("key")).agg(*[_present(s) for s in SPLITS])


def sha_or_empty():
    return F.coalesce("function_sha", F.lit(""))


def _pairwise(name: str, splits=SPLITS):
    """Counts of keys two splits share, as one array of structs per split pair."""
    return [
        F.struct(
            F.lit(a).alias("split_a"),
            F.lit(b).alias("split_b"),
            F.sum(F.col(f"in_{a}") * F.col(f"in_{b}")).cast("bigint").alias(name),
        )
        for a, b in combinations(splits, 2)
    ]


def _overlap(keys: DataFrame, name: str) -> DataFrame:
    pairs = keys.agg(F.array(*_pairwise(name)).alias("pairs"))
    return pairs.select(F.inline("pairs")).withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def exact_dup_overlap(df: DataFrame, ignore_missing: bool = False) -> DataFrame:
    """Per split pair: shared function_sha values and shared (docstring, function) pairs.

    A missing hash counts as one more value unless ``ignore_missing``.
    """
    sha = keys_by_split(df, sha_or_empty())
    if ignore_missing:
        sha = sha.where("key <> ''")
    pair = keys_by_split(df, pair_key("docstring", "function"))
    return _overlap(sha, "sha_overlap").join(_overlap(pair, "pair_overlap"), ["split_a", "split_b"])


def cross_split_keys(df: DataFrame, ignore_missing: bool = False) -> DataFrame:
    """Hashes that occur in more than one split, with their number of splits."""
    keys = keys_by_split(df, sha_or_empty())
    if ignore_missing:
        keys = keys.where("key <> ''")
    n = sum(F.col(f"in_{s}") for s in SPLITS)
    return keys.select(F.col("key").alias("function_sha"), n.cast("bigint").alias("splits")).where("splits > 1")


def split_intersect(df: DataFrame, column: str, a: str, b: str) -> DataFrame:
    """Distinct values two splits have in common."""
    keys = keys_by_split(df.where(F.col("split").isin(a, b)), F.col(column))
    return keys.where((F.col(f"in_{a}") == 1) & (F.col(f"in_{b}") == 1)).select(F.col("key").alias(column))


def split_repo_stats(df: DataFrame) -> DataFrame:
    """Per split: distinct repositories (empty names left out) and samples.

    Counting per (split, nwo) first keeps the distinct count to one row per repository.
    """
    per_repo = df.groupBy("split", F.coalesce("nwo", F.lit("")).alias("nwo")).agg(F.count("*").alias("n"))
    return per_repo.groupBy("split").agg(
        F.count(F.when(F.col("nwo") != "", 1)).alias("repos"),
        F.sum("n").cast("bigint").alias("samples"),
    )


def repo_counts(df: DataFrame) -> DataFrame:
    """One row per repository with its samples per split."""
    counts = [F.count(F.when(F.col("split") == s, 1)).alias(f"n_{s}") for s in SPLITS]
    return df.groupBy(F.coalesce("nwo", F.lit("")).alias("nwo")).agg(*counts)


def repo_contamination(df: DataFrame) -> DataFrame:
    """Per split pair: shared repositories and the second split's samples they touch."""

    def pair(a: str, b: str):
        shared = (F.col("nwo") != "") & (F.col(f"n_{a}") > 0) & (F.col(f"n_{b}") > 0)
        return F.struct(
            F.lit(a).alias("split_a"),
            F.lit(b).alias("split_b"),
            F.count(F.when(shared, 1)).alias("overlap_repos"),
            F.count(F.when((F.col("nwo") != "") & (F.col(f"n_{b}") > 0), 1)).alias("repos_b"),
            F.coalesce(F.sum(F.when(shared, F.col(f"n_{b}"))), F.lit(0)).cast("bigint").alias("samples_affected"),
            F.coalesce(F.sum(f"n_{b}"), F.lit(0)).cast("bigint").alias("samples_b"),
        )

    out = repo_counts(df).agg(F.array(*[pair(a, b) for a, b in combinations(SPLITS, 2)]).alias("p"))

    def percent(part: str, whole: str):
        share = F.try_divide(F.col(part) * F.lit(100.0), F.col(whole))
        return F.round(F.coalesce(share, F.lit(0.0)), 6)

    return (
        out.select(F.inline("p"))
        .withColumn("pct_repos", percent("overlap_repos", "repos_b"))
        .withColumn("pct_samples", percent("samples_affected", "samples_b"))
    )


def top_overlap_repos(df: DataFrame, n: int = 10) -> DataFrame:
    """Per split pair: the n shared repositories with most samples in both together."""
    pairs = F.array(*[
        F.struct(
            F.lit(a).alias("split_a"), F.lit(b).alias("split_b"),
            F.col(f"n_{a}").alias("samples_a"), F.col(f"n_{b}").alias("samples_b"),
        )
        for a, b in combinations(SPLITS, 2)
    ])
    shared = (
        repo_counts(df).where("nwo <> ''")
        .select("nwo", F.inline(pairs))
        .where("samples_a > 0 and samples_b > 0")
    )
    w = Window.partitionBy("split_a", "split_b").orderBy(
        (F.col("samples_a") + F.col("samples_b")).desc(), "nwo"
    )
    return shared.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def docstring_exact_overlap(df: DataFrame) -> DataFrame:
    """Test rows whose normalised docstring also occurs in train; empty docstrings are left out."""
    keys = (
        df.where(F.col("split").isin("train", "test"))
        .groupBy(normalize("docstring").alias("d"))
        .agg(
            F.count(F.when(F.col("split") == "test", 1)).alias("n_test"),
            F.count(F.when(F.col("split") == "train", 1)).alias("n_train"),
        )
        .where("d <> ''")
    )
    total = F.coalesce(F.sum("n_test"), F.lit(0)).cast("bigint")
    hit = F.coalesce(F.sum(F.when(F.col("n_train") > 0, F.col("n_test"))), F.lit(0)).cast("bigint")
    pct = F.round(F.coalesce(F.try_divide(F.col("overlap") * F.lit(100.0), F.col("test_rows")), F.lit(0.0)), 6)
    return keys.agg(hit.alias("overlap"), total.alias("test_rows")).withColumn("pct", pct)
