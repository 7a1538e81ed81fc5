"""Projections, predicates and key parsing on function and repository rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.expr import as_col
from ..functions.hashing import function_sha
from ..functions.lexing import code_tokens

# Path fragments that mark test code and dependencies.
FILTERED_PATHS = ("test", "node_modules")

# Names of inherited methods that are not worth keeping.
BLACKLISTED_NAMES = ("toString", "toLocaleString", "valueOf")

# Languages that can be extracted, with their file extension.
LANGUAGES = {"arkts": "ets"}

STRING_FIELDS = (
    "nwo sha path language identifier parameters argument_list return_statement docstring "
    "docstring_summary function ast_function obf_function"
).split()
LIST_FIELDS = (
    "imports calls local_calls function_tokens ast_function_tokens obf_function_tokens"
).split()
STRIPPED_FIELDS = ("docstring", "docstring_summary", "function", "ast_function", "obf_function")

# Output order of a function row.
FUNCTION_COLUMNS = (
    "nwo sha path language identifier parameters argument_list return_statement imports calls "
    "local_calls docstring docstring_summary docstring_tokens function function_tokens "
    "ast_function ast_function_tokens obf_function obf_function_tokens url function_sha"
).split()


def source_url(nwo, sha, path, start_row, end_row) -> Column:
    """Link to a line range; rows count from zero, links from one."""
    return F.concat(
        F.lit("https://github.com/"), as_col(nwo), F.lit("/blob/"), as_col(sha), F.lit("/"),
        as_col(path), F.lit("#L"), (as_col(start_row) + 1).cast("string"), F.lit("-L"),
        (as_col(end_row) + 1).cast("string"),
    )


def function_record(df: DataFrame, *further: str) -> DataFrame:
    """The 22-column function row, and ``further`` columns as they are.

    Missing columns take their default, texts are stripped, the url and the hash are computed.
    Needs ``start_row`` and ``end_row``.
    """
    have = set(df.columns)
    for c in STRING_FIELDS:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit("")) if c in have else F.lit(""))
    for c in LIST_FIELDS:
        empty = F.array().cast("array<string>")
        df = df.withColumn(c, F.coalesce(F.col(c), empty) if c in have else empty)
    return (
        df.withColumn("docstring_tokens", text.docstring_tokens("docstring_summary"))
        .withColumns({c: text.stripped(c) for c in STRIPPED_FIELDS})
        .withColumn("url", source_url("nwo", "sha", "path", "start_row", "end_row"))
        .withColumn("function_sha", function_sha("docstring", "function"))
        .select(*FUNCTION_COLUMNS, *further)
    )


def join_topics(repos: DataFrame) -> DataFrame:
    return repos.withColumn("topics", F.array_join("topics", " "))


def remote_to_nwo(url) -> Column:
    """owner/repo of a remote url, without a .git suffix; null for other hosts."""
    url = as_col(url)
    gitee = F.regexp_extract(url, r"\Ahttps?://gitee\.com/(.*?)(?:\.git)?\z", 1)
    github = F.regexp_extract(url, r"\Ahttp.+?github\.com/(.*?)(?:\.git)?\z", 1)
    return F.nullif(F.when(F.contains(url, F.lit("gitee")), gitee).otherwise(github), F.lit(""))


def path_to_nwo(path) -> tuple[Column, Column]:
    """(owner/repo, path inside the repository) of /root-a/root-b/owner/repo/…"""
    parts = F.split(as_col(path), "/", -1)
    return (
        F.array_join(F.slice(parts, 4, 2), "/"),
        F.array_join(F.slice(parts, F.lit(6), F.greatest(F.size(parts), F.lit(1))), "/"),
    )


def repo_key(name, source) -> Column:
    """owner/repo from owner/repo or owner##repo; null when there is no owner."""
    name, source = as_col(name), as_col(source)
    gitee = source == "gitee"
    hashes = gitee & F.contains(name, F.lit("##"))
    owner = F.when(hashes, F.substring_index(name, "##", 1)).otherwise(
        F.substring_index(name, "/", 1)
    )
    skip = F.length(owner) + F.when(hashes, F.lit(3)).otherwise(F.lit(2))
    repo = F.substr(name, skip)
    repo = F.replace(F.when(gitee, F.replace(repo, F.lit("_arkts"), F.lit(""))).otherwise(repo),
                     F.lit(".git"), F.lit(""))
    known = hashes | F.contains(name, F.lit("/"))
    return F.when(known, F.concat(owner, F.lit("/"), repo))


def is_source_path(path) -> Column:
    return ~F.lower(as_col(path)).rlike("|".join(FILTERED_PATHS))


def has_min_tokens(tokens, more_than: int = 1) -> Column:
    return F.size(as_col(tokens)) > more_than


def has_allowed_name(identifier) -> Column:
    return ~as_col(identifier).isin(*BLACKLISTED_NAMES)


def within_size(content, max_bytes: int | None) -> Column:
    """Whether a text is within a limit; without one every text is, null ones aside."""
    size = F.octet_length(as_col(content))
    return size.isNotNull() if max_bytes is None else F.coalesce(size <= max_bytes, F.lit(False))


def is_supported_language(language) -> Column:
    return F.lower(as_col(language)).isin(*LANGUAGES)


def flatten_tokens(lists) -> Column:
    return F.flatten(as_col(lists))


def with_code_tokens(df: DataFrame, column: str = "function") -> DataFrame:
    return df.withColumn(f"{column}_tokens", code_tokens(column))
