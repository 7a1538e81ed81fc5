"""Calls in applications linked to function definitions in the libraries they import."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import as_col
from .project import source_url


def library_of(context) -> Column:
    """First dotted segment of an imported name."""
    return F.substring_index(as_col(context), ".", 1)


def libraries_of(mapped: Column | None = None, listed: Column | None = None) -> Column:
    """Libraries of one import context: first segments of a map's values, list entries as they are."""
    empty = F.array().cast("array<string>")
    values = F.transform(F.map_values(mapped), library_of) if mapped is not None else empty
    listed = listed if listed is not None else empty
    return F.array_distinct(F.concat(F.coalesce(values, empty), F.coalesce(listed, empty)))


def is_telling(identifier: Column) -> Column:
    """Names specific enough to match on their own: long ones, or public ones with an underscore."""
    return (F.length(identifier) > 9) | (~identifier.startswith("_") & F.contains(identifier, F.lit("_")))


def call_links(
    calls: DataFrame,
    imports: DataFrame,
    definitions: DataFrame,
    stopwords: list[str] | None = None,
) -> DataFrame:
    """One row per (call, matching definition in a library the call's file imports).

    calls: nwo, sha, path, identifier, argument_list, start_row, end_row;
    imports: nwo, path, library; definitions: library, identifier, url.
    A constructor definition ``X.__init__`` answers to a call of ``X``; any other needs its exact,
    telling name. Definitions are keyed by the name they answer to, so both rules are one join, and
    telling names have few definitions: calls meet those first, and the imports of a file only
    confirm a library, which multiplies nothing. Returns the call columns (with ``language`` where
    calls have it), the call's url and the definition's url.
    """
    init = F.substring_index("identifier", ".", -1) == "__init__"
    first = library_of("identifier")
    answers = F.when(init, F.array(
        F.struct(first.alias("name"), F.lit(True).alias("by_class")),
        F.struct(F.col("identifier").alias("name"), F.lit(False).alias("by_class")),
    )).otherwise(F.array(F.struct(F.col("identifier").alias("name"), F.lit(False).alias("by_class"))))
    targets = (
        definitions.select("library", F.col("url").alias("definition_url"), F.inline(answers))
        .withColumnRenamed("name", "identifier")
        .where(F.col("by_class") | is_telling(F.col("identifier")))
        .drop("by_class")
    )
    if stopwords:
        calls = calls.where(~F.col("identifier").isin(stopwords))
    scope = imports.select("nwo", "path", "library")
    # Merged: every definition of every library is no table to send through the driver.
    linked = calls.join(targets.hint("merge"), "identifier").join(scope.hint("merge"), ["nwo", "path", "library"], "left_semi")
    kept = ["nwo", "sha", "path", *[c for c in ("language",) if c in calls.columns], "identifier", "argument_list"]
    return linked.select(
        *kept, source_url("nwo", "sha", "path", "start_row", "end_row").alias("call_url"), "definition_url"
    )


def link_edges(links: DataFrame) -> DataFrame:
    """The distinct edges (call_url, definition_url) alone."""
    return links.select("call_url", "definition_url").distinct()
