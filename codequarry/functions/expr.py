"""Small helpers for composing Column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Catalyst inlines a projected expression into every lambda that mentions it, so a
    regex under a ``transform`` would run once per element. Binding it through a
    one-element array keeps it at one evaluation per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def count_newlines(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that Catalyst evaluates once and in place.

    Projections built on each other are merged, and filters on a computed column are pushed
    below it with its expression copied; a chain of regexes grows past what can be compiled that
    way. Neither crosses a generator, so the columns are made by inlining one struct per row.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
