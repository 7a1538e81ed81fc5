"""Near-duplicate detection between train and test by MinHash-LSH."""

import functools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import staged
from ..functions.hashing import NUM_PERM, PRIME, signature_similarity, text_hash31, with_minhash, with_shingle_sets
from ..functions.text import shingles_of, word_tokens
from ..session import written
from .similarity import compared, similar_sets
from .skew import skew_join

# The thresholds a report has.
THRESHOLDS = (0.5, 0.7, 0.8, 0.9)


@functools.cache
def banding(threshold: float, num_perm: int = NUM_PERM) -> tuple[int, int]:
    """(bands, rows per band) with the least sum of both error areas: the chance of meeting below
    the threshold and the chance of missing above it, weighted equally."""
    s = np.linspace(0.0, 1.0, 2001)
    below = s <= threshold
    best = None
    for rows in range(1, num_perm + 1):
        for bands in range(1, num_perm // rows + 1):
            meet = 1.0 - (1.0 - s**rows) ** bands
            error = np.trapezoid(np.where(below, meet, 0.0), s) + np.trapezoid(np.where(below, 0.0, 1.0 - meet), s)
            if best is None or error < best[0]:
                best = (error, bands, rows)
    return best[1:]


def contents(df: DataFrame, id_col: str, keep_empty: bool = False) -> DataFrame:
    """Distinct train/test contents: (key, test_id, train_id, n_test, n_train, signature).

    Functions with the same word tokens have the same shingles, so they share one row that
    counts its copies per split and names the smallest id of each. Copies combine on ids and keys
    alone; then one function of each key is looked up again (ids are unique within a split) and
    signed. Functions without tokens are left out, or with ``keep_empty`` are one content of their own.
    """
    is_test, is_train = F.col("split") == "test", F.col("split") == "train"
    rows = df.where(F.col("split").isin("train", "test")).select(
        F.col(id_col).alias("id"), "split", F.coalesce("function", F.lit("")).alias("function")
    )
    rows = staged(rows, tokens=word_tokens("function")).drop("function")
    if not keep_empty:
        rows = rows.where(F.size("tokens") > 0)
    rows = rows.withColumn("key", F.md5(F.array_join("tokens", " ")))
    keys = rows.groupBy("key").agg(
        F.min(F.when(is_test, F.col("id"))).alias("test_id"),
        F.min(F.when(is_train, F.col("id"))).alias("train_id"),
        F.count(F.when(is_test, 1)).alias("n_test"),
        F.count(F.when(is_train, 1)).alias("n_train"),
    )
    # The smallest test id, or train id where there is none, carries the tokens.
    carriers = keys.withColumns({
        "split": F.when(F.col("n_test") > 0, "test").otherwise("train"),
        "id": F.coalesce("test_id", "train_id"),
    })
    signed = rows.select("key", "split", "id", "tokens").join(carriers, ["key", "split", "id"])
    signed = with_minhash(signed, F.transform(shingles_of(F.col("tokens")), text_hash31))
    if keep_empty:
        # No hash reaches the modulus, so empty functions are like each other and nothing else.
        nothing = F.array_repeat(F.lit(PRIME).cast("bigint"), NUM_PERM)
        signed = signed.withColumn("signature", F.coalesce("signature", nothing))
    return signed.select("key", "test_id", "train_id", "n_test", "n_train", "signature")


def _bands(thresholds) -> Column:
    """(threshold, band, hash of the band's rows) of every banding of ``signature``."""
    bands = ", ".join(
        f"named_struct('threshold', {t}D, 'band', {i}, 'bucket', xxhash64(slice(signature, {i * rows + 1}, {rows})))"
        for t in thresholds
        for n, rows in [banding(t)]
        for i in range(n)
    )
    return F.expr(f"array({bands})")


def candidates(table: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Pairs of distinct contents that share a band: (test_key, train_key, thresholds)."""

    def banded(side: str) -> DataFrame:
        rows = table.where(F.col(f"n_{side}") > 0)
        return rows.select(F.col("key").alias(f"{side}_key"), F.inline(_bands(thresholds)))

    met = skew_join(banded("train"), banded("test"), ["threshold", "band", "bucket"], ["train_key"], ["test_key"])
    return met.groupBy("test_key", "train_key").agg(
        F.collect_set("threshold").alias("thresholds")  # at most one entry per threshold
    )


def verified(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """Signature similarity of candidate pairs, with the copy counts of both contents."""
    test = table.where("n_test > 0").select(
        F.col("key").alias("test_key"), "test_id", "n_test", F.col("signature").alias("test_signature")
    )
    train = table.where("n_train > 0").select(
        F.col("key").alias("train_key"), "train_id", "n_train", F.col("signature").alias("train_signature")
    )
    joined = pairs.join(test, ["test_key"])
    joined = joined.join(train, ["train_key"])
    return joined.withColumn(
        "similarity", signature_similarity(F.col("test_signature"), F.col("train_signature"))
    ).drop("test_signature", "train_signature")


def near_dup_pairs(
    df: DataFrame, id_col: str = "id", thresholds=THRESHOLDS, keep_empty: bool = False
) -> DataFrame:
    """Candidate pairs whose estimated similarity reaches a threshold, one row per threshold.

    A pair stands for all copies of its two contents: test_rows x train_rows row pairs, named by
    the smallest id on either side.
    """
    table = written(contents(df, id_col, keep_empty), "contents")
    pairs = verified(table, candidates(table, thresholds))
    return (
        pairs.select("*", F.explode("thresholds").alias("threshold"))
        .where("similarity >= threshold")
        .select(
            "threshold", "test_id", "train_id",
            F.col("n_test").alias("test_rows"), F.col("n_train").alias("train_rows"), "similarity",
        )
    )


def near_dup_best(df: DataFrame, id_col: str = "id", threshold: float = 0.7, keep_empty: bool = False) -> DataFrame:
    """The most similar train content of each test content, if it reaches ``threshold``; ties go to
    the smaller train id. One row per test content, however many train contents are near it."""
    pairs = near_dup_pairs(df, id_col, (threshold,), keep_empty).drop("threshold")
    best = F.min_by(F.struct("train_id", "train_rows"), F.struct(-F.col("similarity"), F.col("train_id")))
    return (
        pairs.groupBy("test_id", "test_rows")
        .agg(F.max("similarity").alias("similarity"), best.alias("b"))
        .select("test_id", "b.train_id", "test_rows", "b.train_rows", "similarity")
    )


def near_dup_summary(
    df: DataFrame, id_col: str = "id", thresholds=THRESHOLDS, keep_empty: bool = False
) -> DataFrame:
    """Per threshold: test rows with a candidate, test rows with a verified match, row pairs."""
    table = written(contents(df, id_col, keep_empty), "contents")
    pairs = verified(table, candidates(table, thresholds)).select("*", F.explode("thresholds").alias("threshold"))
    close = F.col("similarity") >= F.col("threshold")
    per_test = pairs.groupBy("threshold", "test_key").agg(
        F.first("n_test").alias("n_test"),
        F.sum(F.when(close, F.col("n_test") * F.col("n_train"))).alias("row_pairs"),
    )
    counted = per_test.groupBy("threshold").agg(
        F.sum("n_test").alias("candidate_rows"),
        F.sum(F.when(F.col("row_pairs").isNotNull(), F.col("n_test"))).alias("verified_rows"),
        F.sum("row_pairs").alias("verified_pairs"),
    )
    total = df.where("split = 'test'").agg(F.count("*").alias("test_rows"))
    spark = df.sparkSession
    all_thresholds = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in thresholds])).alias("threshold"))
    zero = F.lit(0).cast("bigint")
    out = (
        all_thresholds.join(counted, "threshold", "left")
        .withColumn("test_rows", total.scalar())
        .withColumns({c: F.coalesce(c, zero).cast("bigint") for c in ("candidate_rows", "verified_rows", "verified_pairs")})
    )
    pct = F.coalesce(F.try_divide(F.col("candidate_rows") * F.lit(100.0), F.col("test_rows")), F.lit(0.0))
    return out.withColumn("pct", F.round(pct, 6))


def top_near_dups(df: DataFrame, id_col: str = "id", threshold: float = 0.5, n: int = 10) -> DataFrame:
    """The n most similar verified pairs at a threshold."""
    return (
        near_dup_pairs(df, id_col, (threshold,))
        .orderBy(F.col("similarity").desc(), "test_id", "train_id")
        .limit(n)
        .select("test_id", "train_id", "similarity")
    )


@functools.cache
def sure_banding(threshold: float, recall: float = 0.98, num_perm: int = NUM_PERM) -> tuple[int, int]:
    """(bands, rows per band) with the most rows, so the fewest chance meetings, for which a pair at
    the threshold meets with at least the probability ``recall``."""
    for rows in range(num_perm, 0, -1):
        bands = num_perm // rows
        if 1.0 - (1.0 - threshold**rows) ** bands >= recall:
            return bands, rows
    return num_perm, 1


def _set_rows(df: DataFrame, id_col: str, tokens: bool = True, signed: bool = False) -> DataFrame:
    """(id, split, key, size) of every train/test function with shingles, on request with its
    tokens, the hashed shingles, and its signature."""
    text = F.coalesce("function", F.lit("")).alias("function")
    rows = df.where(F.col("split").isin("train", "test")).select(F.col(id_col).alias("id"), "split", text)
    return with_shingle_sets(rows, "function", tokens, signed)


def _shingle_sets(df: DataFrame, id_col: str, bandings: list[tuple[int, int]] = ()) -> DataFrame:
    """Distinct shingle sets: (id, key, test_id, train_id, n_test, n_train) and, for the (bands, rows) of
    ``bandings`` one after the other, the buckets of the signature's bands. Not the sets themselves,
    which are larger than the texts; ``_sides`` makes those."""
    rows = _set_rows(df, id_col, tokens=False, signed=bool(bandings))
    buckets = ", ".join(f"xxhash64(slice(signature, {i * n + 1}, {n}))" for bands, n in bandings for i in range(bands))
    sets = (rows.withColumn("buckets", F.expr(f"array({buckets})")) if bandings else rows).groupBy("key").agg(
        F.min(F.when(F.col("split") == "test", F.col("id"))).alias("test_id"),
        F.min(F.when(F.col("split") == "train", F.col("id"))).alias("train_id"),
        F.count(F.when(F.col("split") == "test", 1)).alias("n_test"),
        F.count(F.when(F.col("split") == "train", 1)).alias("n_train"),
        *([F.first("buckets").alias("buckets")] if bandings else []),
    )
    # Written once, since the short ids are given anew each time.
    return written(sets.withColumn("id", F.monotonically_increasing_id()), "shingle-sets")


def _sides(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(key, tokens) of the test and of the train functions, made from the texts when read."""
    return tuple(_set_rows(df.where(F.col("split") == s), id_col).select("key", "tokens") for s in ("test", "train"))


def _named(pairs: DataFrame, table: DataFrame) -> DataFrame:
    l_ids = table.where("n_test > 0").select(F.col("key").alias("left_key"), "test_id", "n_test")
    r_ids = table.where("n_train > 0").select(F.col("key").alias("right_key"), "train_id", "n_train")
    pairs = pairs.join(l_ids, ["left_key"])
    pairs = pairs.join(r_ids, ["right_key"])
    return pairs.select(
        "test_id", "train_id", F.col("n_test").alias("test_rows"), F.col("n_train").alias("train_rows"), "similarity"
    )


def _sure_pairs(table: DataFrame, left: DataFrame, right: DataFrame, thresholds, recall: float) -> DataFrame:
    """(threshold, left_key, right_key, similarity) of the sets that meet in a band of the threshold and
    reach it. The table has the bands of all thresholds; pairs of several are compared once."""
    tests = table.where("n_test > 0").select(F.col("id").alias("left_id"), F.posexplode("buckets").alias("band", "bucket"))
    trains = table.where("n_train > 0").select(F.col("id").alias("right_id"), F.posexplode("buckets").alias("band", "bucket"))
    met = skew_join(trains, tests, ["band", "bucket"], ["right_id"], ["left_id"])
    bands = [t for t in thresholds for _ in range(sure_banding(t, recall)[0])]
    threshold = F.element_at(F.array(*[F.lit(float(t)) for t in bands]), F.col("band") + 1)
    met = met.groupBy("left_id", "right_id").agg(
        F.collect_set(threshold).alias("thresholds")  # at most one entry per threshold
    )
    met, names = written(met, "candidates"), table.select("id", "key")
    close = compared(met.select("left_id", "right_id"), names, names, left, right, min(thresholds))
    return (
        close.join(met.select("left_id", "right_id", F.explode("thresholds").alias("threshold")), ["left_id", "right_id"])
        .where("similarity >= threshold")
        .select("threshold", "left_key", "right_key", "similarity")
    )


def near_dup_sure(df: DataFrame, id_col: str = "id", threshold: float = 0.7, recall: float = 0.98) -> DataFrame:
    """Near-duplicate pairs by bands chosen for their recall at the threshold, and an exact check.

    The pairs of ``near_dup_exact`` but for those that meet in no band, a share of at most
    1 - ``recall`` even at the threshold; ``near_dup_recall`` measures it.
    """
    table = _shingle_sets(df, id_col, [sure_banding(threshold, recall)])
    return _named(_sure_pairs(table, *_sides(df, id_col), (threshold,), recall).drop("threshold"), table)


def near_dup_recall(
    df: DataFrame, id_col: str = "id", thresholds: tuple[float, ...] = (0.7, 0.8, 0.9), recall: float = 0.98, sample: int = 1
) -> DataFrame:
    """Per threshold: pairs that the exact join has, those of them that ``near_dup_sure`` finds, and
    the recall. With ``sample``, test sets with a key hash divisible by it are asked against all."""
    table = _shingle_sets(df, id_col, [sure_banding(t, recall) for t in thresholds])
    left, right = _sides(df, id_col)
    asked = left.where(F.pmod(F.xxhash64("key"), F.lit(sample)) == 0) if sample > 1 else left
    exact = written(similar_sets(asked, right, min(thresholds)), "exact-pairs")
    sure = written(_sure_pairs(table, left, right, thresholds, recall), "sure-pairs")
    rows = None
    for t in thresholds:
        found = sure.where(F.col("threshold") == t).select("left_key", "right_key", F.lit(True).alias("found"))
        met = exact.where(F.col("similarity") >= t).join(found, ["left_key", "right_key"], "left")
        one = met.agg(F.count(F.lit(1)).alias("exact_pairs"), F.count("found").alias("found_pairs")).select(F.lit(t).alias("threshold"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return rows.withColumn("recall", F.round(F.coalesce(F.try_divide("found_pairs", "exact_pairs"), F.lit(1.0)), 6))


def near_dup_exact(df: DataFrame, id_col: str = "id", threshold: float = 0.7) -> DataFrame:
    """Pairs of distinct contents with exact shingle Jaccard of at least ``threshold``.

    The alternative to banding when no pair may be missed.
    """
    table = _shingle_sets(df, id_col)
    return _named(similar_sets(*_sides(df, id_col), threshold), table)
