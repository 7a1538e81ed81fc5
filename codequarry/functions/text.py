"""Docstring and code text functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import as_col, let

# Whitespace as Python's str.strip / \s see it. Java's \s is ASCII unless (?U) is on, and even
# then leaves out the four information separators.
_WS = r"[\s\x1c-\x1f]"

# Fixed value: the docstring token alternatives. Inside the first class "+-/" is a range in the
# dialect it was written for, hence the five characters + , - . / here; braces need escaping.
DOCSTRING_TOKEN = (
    r"""(?U)[^\s\x1c-\x1f,'"`.():\[\]=*;>{}+\-/\\]+"""
    r"""|\\+|\.+|\(\)|\{\}|\[\]|\(+|\)+|:+|\[+|\]+|\{+|\}+|=+|\*+|;+|>+|\++|-+|/+"""
)

# Fixed value: audit token pattern.
WORD_TOKEN = r"[a-zA-Z0-9_]+"


def strip(c) -> Column:
    """Unicode-aware strip of both ends."""
    # The look-behind tries a run of blanks inside the text once, not from each of its characters.
    return F.regexp_replace(as_col(c), rf"(?U)\A{_WS}+|(?<!{_WS}){_WS}+\z", "")


def is_blank(c) -> Column:
    """Whether ``strip`` leaves nothing."""
    return as_col(c).rlike(rf"(?U)\A{_WS}*+\z")


def stripped(c) -> Column:
    """``strip`` of a column that seldom has blanks at its ends: others are not searched."""
    c = as_col(c)
    ends = F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1))
    return F.when(ends.rlike(rf"(?U){_WS}"), strip(c)).otherwise(c)


def normalize(c) -> Column:
    """Strip, lower, squeeze whitespace runs to one space; null counts as empty."""
    text = F.lower(strip(F.coalesce(as_col(c), F.lit(""))))
    return F.regexp_replace(text, rf"(?U){_WS}+", " ")


def docstring_tokens(c) -> Column:
    return F.regexp_extract_all(as_col(c), F.lit(DOCSTRING_TOKEN), F.lit(0))


def word_tokens(c) -> Column:
    return F.regexp_extract_all(as_col(c), F.lit(WORD_TOKEN), F.lit(0))


def shingles_of(tokens: Column, k: int = 3) -> Column:
    """Distinct k-token shingles; fewer than k tokens join without a space, none give an empty array."""

    def build(t: Column) -> Column:
        n = F.size(t)
        windows = F.transform(
            F.sequence(F.lit(1), n - (k - 1)),
            lambda i: F.array_join(F.array(*[F.element_at(t, i + j) for j in range(k)]), " "),
        )
        return (
            F.when(n == 0, F.array().cast("array<string>"))
            .when(n < k, F.array(F.array_join(t, "")))
            .otherwise(F.array_distinct(windows))
        )

    return let(tokens, build)


def shingles(c, k: int = 3) -> Column:
    return shingles_of(word_tokens(c), k)


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two distinct-element arrays: both empty give 1, one empty gives 0."""
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(
            let(
                F.size(F.array_intersect(a, b)),
                lambda both: both / (F.size(a) + F.size(b) - both),
            )
        )
    )


def token_jaccard(a, b) -> Column:
    """Jaccard of the word-token sets of two texts."""
    return let(
        F.array_distinct(word_tokens(a)),
        lambda x: let(F.array_distinct(word_tokens(b)), lambda y: jaccard(x, y)),
    )


def strip_comment(c) -> Column:
    """Drop C-style comment markers line by line: a closing marker, then one opening marker."""

    def clean(line: Column) -> Column:
        line = F.regexp_replace(strip(line), r"\*/\z", "")
        return strip(F.regexp_replace(line, r"\A(?:\*|/\*\*|//|/\*)", ""))

    return F.array_join(F.transform(F.split(as_col(c), "\n", -1), clean), "\n")


def docstring_summary(c) -> Column:
    """Text before the first blank line, else before the first @, else all of it."""
    c = as_col(c)
    return (
        F.when(F.contains(c, F.lit("\n\n")), F.substring_index(c, "\n\n", 1))
        .when(F.contains(c, F.lit("@")), F.substring_index(c, "@", 1))
        .otherwise(c)
    )


def is_license_comment(c) -> Column:
    low = F.lower(as_col(c))
    return F.contains(low, F.lit("copyright")) & F.contains(low, F.lit("license"))


def _size_or_zero(c: Column, size: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(0)).otherwise(size).cast("int")


def line_count(c) -> Column:
    c = as_col(c)
    return _size_or_zero(c, F.size(F.split(c, "\n", -1)))


def char_count(c) -> Column:
    c = as_col(c)
    return _size_or_zero(c, F.length(c))


def ast_length(c) -> Column:
    """Number of '#'-separated parts of a flattened syntax tree."""
    c = as_col(c)
    return _size_or_zero(c, F.size(F.split(c, "#", -1)))


def has_text(c) -> Column:
    return F.coalesce(as_col(c), F.lit("")) != ""
