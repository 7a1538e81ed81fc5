"""Enrichment, deduplication, licence filtering and merging."""

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import exact_key, short_sha
from ..session import written
from .project import join_topics, repo_key

# Licence ids whose code may be redistributed; spelling matters.
ALLOWED_LICENSES = (
    "0BSD", "ZLIB", "ISC", "BSD-3-CLAUSE", "BSD-2-CLAUSE",
    "APACHE-2.0", "Apache-2.0", "MIT",
    "LGPL-3.0", "LGPL-2.1",
    "EPL-1.0", "MULANPSL-2.0", "MulanPSL-2.0",
    "CC-BY-4.0", "MPL-2.0", "BSD-3-Clause", "Unlicense",
)

# Columns a merged dataset leaves out.
DROPPED_KEYS = (
    "parameters", "argument_list", "return_statement", "imports", "calls", "local_calls",
    "docstring_summary", "docstring_tokens", "obf_function_tokens", "ast_function_tokens",
    "function_tokens",
)

ENRICHED_COLUMNS = (
    "function_sha url nwo language path identifier parameters imports calls local_calls "
    "argument_list return_statement docstring docstring_summary docstring_tokens function "
    "function_tokens ast_function ast_function_tokens obf_function obf_function_tokens topics "
    "forks_count stargazers_count watchers"
).split()


def distinct_repos(repos: DataFrame) -> DataFrame:
    """One row per full_name: the one with most stars, so a join on it cannot fan out."""
    rest = [c for c in repos.columns if c != "full_name"]
    best = F.max_by(F.struct(*rest), F.struct(F.coalesce("stargazers_count", F.lit(-1)), *rest))
    return repos.groupBy("full_name").agg(best.alias("r")).select("full_name", "r.*")


def enrich(functions: DataFrame, repos: DataFrame) -> DataFrame:
    """Left join functions with repository info; 25 columns, hashes cut to 32 characters."""
    info = distinct_repos(join_topics(repos)).select(
        F.col("full_name").alias("nwo"),
        "topics",
        F.col("forks").alias("forks_count"),
        "stargazers_count",
        "watchers",
    )
    functions = functions.withColumn("function_sha", short_sha("function_sha"))
    joined = functions.join(info, "nwo", "left")
    return joined.select(*[c for c in ENRICHED_COLUMNS if c in joined.columns])


def best_functions(enriched: DataFrame) -> DataFrame:
    """Best-starred row per function_sha, and how many urls share the hash.

    The winner is chosen on thin columns: each task sends one candidate per hash, so a hash that
    owns a third of the table still sends one row per task, and function texts are neither sorted
    nor aggregated. Then whole rows are looked up, by hash and a digest of the row.
    Ties go to the smaller url, then path; rows alike in all columns are one.
    """
    digest = F.xxhash64(*enriched.columns)
    rank = F.struct(
        F.col("stargazers_count").isNull(),
        -F.col("stargazers_count"),
        F.col("url").isNull(),
        F.col("url"),
        F.col("path"),
        F.col("_row"),
    )
    thin = enriched.select("function_sha", "stargazers_count", "url", "path", digest.alias("_row"))
    winners = thin.groupBy(F.col("function_sha").alias("_sha")).agg(
        F.min_by("_row", rank).alias("_best"), F.count("url").alias("duplicate_count")
    )
    rows = enriched.withColumn("_row", digest)
    won = rows["function_sha"].eqNullSafe(winners["_sha"]) & (rows["_row"] == winners["_best"])
    return rows.join(winners, won).select(*enriched.columns, "duplicate_count").distinct()


def duplicate_urls(enriched: DataFrame) -> DataFrame:
    """The duplicates of every hash in long form: one row per (function_sha, url).

    Includes the url of the kept row; null urls are left out. Long form, because the list of a
    hash shared by a third of all rows fits no single row or task.
    """
    return enriched.where(F.col("url").isNotNull()).select(
        "function_sha", F.col("url").alias("duplicate_url")
    )


def duplicate_lists(enriched: DataFrame, page_size: int = 1000) -> DataFrame:
    """The duplicates of every hash as numbered, sorted pages of ``page_size`` urls, the last shorter.

    Returns (function_sha, page, first_url, duplicates). A url's page follows from its rank within
    the hash: its place in a range plus the rows of the hash in the ranges before. The range shuffle
    on (hash, url) cuts hot hashes across tasks, and only counts per hash and range meet in one.
    """
    ranged = duplicate_urls(enriched).repartitionByRange("function_sha", "duplicate_url")
    ranged = ranged.withColumn("_range", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy("function_sha", "_range").orderBy("duplicate_url"))
    # Written, as both branches below need the same ranges.
    ranged = written(ranged.withColumn("_place", place), "ranged-urls")
    counts = ranged.groupBy("function_sha", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("function_sha").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("function_sha").alias("_sha"), F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    same = ranged["function_sha"].eqNullSafe(counts["_sha"]) & (ranged["_range"] == counts["_of"])
    page = F.floor((F.col("_before") + F.col("_place") - 1) / page_size)
    return (
        ranged.join(counts, same)
        .groupBy("function_sha", page.alias("page"))
        .agg(F.array_sort(F.collect_list("duplicate_url")).alias("duplicates"))
        .select("function_sha", "page", F.col("duplicates")[0].alias("first_url"), "duplicates")
    )


def keep_first(df: DataFrame, key: Column, order: list) -> DataFrame:
    """First row per key in the given order.

    The rank limit runs before the shuffle as well (Spark's window group limit), so copies of
    one key shrink to one row per task before they meet.
    """
    w = Window.partitionBy("_key").orderBy(*order)
    ranked = df.withColumn("_key", key).withColumn("_rank", F.row_number().over(w))
    return ranked.where("_rank = 1").drop("_key", "_rank")


def filter_docstring(df: DataFrame, order: list, deduplicate: bool = True) -> DataFrame:
    """Rows with a docstring, first per (docstring, function) unless told otherwise."""
    df = df.where(F.coalesce("docstring", F.lit("")) != "")
    if not deduplicate:
        return df
    return keep_first(df, exact_key("docstring", "function"), order)


def merge_datasets(
    sources: list[DataFrame],
    order: list[str],
    labels: list[str] | None = None,
    drop_keys=DROPPED_KEYS,
) -> DataFrame:
    """Union of sources with differing columns, first row per (docstring, function).

    A label overrides an existing ``source``. In the key, a column a source lacks counts as '',
    while an explicit null stays a value of its own. ``order`` ranks rows inside one source.
    """
    parts = []
    for i, df in enumerate(sources):
        if labels:
            df = df.withColumn("source", F.lit(labels[i]))
        absent = F.lit("")
        key = exact_key(*[F.col(c) if c in df.columns else absent for c in ("docstring", "function")])
        parts.append(df.withColumn("_merge_key", key).drop(*drop_keys).withColumn("_ordinal", F.lit(i)))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return keep_first(union, F.col("_merge_key"), ["_ordinal", *order]).drop("_merge_key", "_ordinal")


def canonical_repo(name: str, source: str) -> Column:
    """owner/repo where a name can be read as such, else the name; null as ''."""
    return F.coalesce(repo_key(name, F.coalesce(F.col(source), F.lit(""))), F.col(name), F.lit(""))


def field(name: str, absent: str | None = None) -> Column:
    """A record's value as text; ``absent`` for a record without the key, null for a null."""
    value = F.try_element_at("record", F.lit(name)).cast("string")
    return F.when(F.map_contains_key("record", name), value).otherwise(F.lit(absent).cast("string"))


def _record_key() -> Column:
    return exact_key(field("docstring", ""), field("function", ""))


def filter_docstring_records(records: DataFrame, order: list, deduplicate: bool = True) -> DataFrame:
    """``filter_docstring`` of free-form records (a column ``record``), all keys kept."""
    kept = records.where(F.coalesce(field("docstring"), F.lit("")) != "")
    return keep_first(kept, _record_key(), order) if deduplicate else kept


def merge_records(
    sources: list[DataFrame], order: list[str], labels: list[str] | None = None, drop_keys=DROPPED_KEYS
) -> DataFrame:
    """``merge_datasets`` of free-form records: whichever keys a record has, but the dropped ones.

    An absent key counts as '' record by record; a null stays a value of its own.
    """
    parts = []
    for i, df in enumerate(sources):
        gone = [*drop_keys, "source"] if labels else [*drop_keys]
        record = F.map_filter("record", lambda k, _: ~k.isin(gone)) if gone else F.col("record")
        if labels:
            record = F.map_concat(record, F.create_map(F.lit("source"), F.parse_json(F.lit(json.dumps(labels[i])))))
        parts.append(df.select(record.alias("record"), *order, F.lit(i).alias("_ordinal"), _record_key().alias("_merge_key")))
    union = reduce(DataFrame.unionByName, parts)
    return keep_first(union, F.col("_merge_key"), ["_ordinal", *order]).drop("_merge_key", "_ordinal")


def filter_license_records(records: DataFrame, licenses: DataFrame, any_case: bool = False) -> DataFrame:
    """``filter_license`` of free-form records."""
    keyed = records.withColumns({"source": field("source"), "nwo": field("nwo")})
    return filter_license(keyed, licenses, any_case).drop("source", "nwo")


def license_map(records: DataFrame, order: str = "line_no") -> DataFrame:
    """(source, repo) -> license; the last record of a repository wins.

    Names are compared as owner/repo, so ``owner##repo`` and a ``.git`` suffix do not tell apart.
    """
    return (
        records.groupBy(
            F.coalesce("source", F.lit("")).alias("source"),
            canonical_repo("repo", "source").alias("repo"),
        )
        .agg(F.max_by(F.struct("license"), F.col(order)).alias("r"))
        .select("source", "repo", "r.license")
    )


def is_allowed_license(license: Column, any_case: bool = False) -> Column:
    """Allow-list test; a null licence is not allowed."""
    if any_case:
        upper = sorted({x.upper() for x in ALLOWED_LICENSES})
        return F.coalesce(F.upper(license).isin(upper), F.lit(False))
    return F.coalesce(license.isin(*ALLOWED_LICENSES), F.lit(False))


def with_allowed_flag(records: DataFrame, any_case: bool = False) -> DataFrame:
    return records.withColumn("allowed", is_allowed_license(F.col("license"), any_case))


def filter_license(df: DataFrame, licenses: DataFrame, any_case: bool = False) -> DataFrame:
    """Rows of repositories whose licence is allowed. ``licenses`` has one row per (source, repo)."""
    allowed = licenses.where(is_allowed_license(F.col("license"), any_case)).select(
        F.col("source").alias("_source"), F.col("repo").alias("_nwo")
    )
    keyed = df.withColumn("_source", F.coalesce("source", F.lit(""))).withColumn(
        "_nwo", canonical_repo("nwo", "source")
    )
    return keyed.join(allowed, ["_source", "_nwo"], "left_semi").drop("_source", "_nwo")


def pending_units(units: DataFrame, finished: DataFrame, on: list[str]) -> DataFrame:
    """Units whose result does not exist yet."""
    return units.join(finished.select(*on), on, "left_anti")


def success_and_failure(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Split a run's rows by outcome; a null outcome is a failure."""
    good = F.coalesce(ok, F.lit(False))
    return df.where(good), df.where(~good)
