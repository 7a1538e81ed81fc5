"""Dataset statistics: lengths, shares, histograms, density curves, top repositories."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

MEASURES = ("function_lines", "docstring_len", "function_len", "ast_len")


def length_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "function_lines": text.line_count("function"),
        "function_len": text.char_count("function"),
        "docstring_len": text.char_count("docstring"),
        "ast_len": text.ast_length("ast_function"),
        "has_identifier": text.has_text("identifier"),
    })


def dataset_stats(df: DataFrame) -> DataFrame:
    return length_columns(df).agg(
        F.count("*").alias("records"),
        F.round(F.avg("function_lines"), 6).alias("mean_function_lines"),
        F.round(F.avg("function_len"), 6).alias("mean_function_len"),
        F.round(F.avg("docstring_len"), 6).alias("mean_docstring_len"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Value counts with each value's percentage, one decimal."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n").alias("total"))
    return counts.withColumn("pct", F.round(F.col("n") * F.lit(100.0) / total.scalar(), 1))


def identifier_share(df: DataFrame) -> DataFrame:
    flagged = df.select(F.when(text.has_text("identifier"), "Yes").otherwise("No").alias("has_identifier"))
    return shares(flagged, "has_identifier")


def top_repos(df: DataFrame, n: int = 10) -> DataFrame:
    return value_counts(df, "nwo").orderBy(F.col("n").desc(), "nwo").limit(n)


def measure_counts(df: DataFrame) -> DataFrame:
    """(measure, value, n): rows per distinct length, all four measures in one pass."""
    pairs = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("value")) for m in MEASURES
    ])
    return length_columns(df).select(F.inline(pairs)).groupBy("measure", "value").agg(F.count("*").alias("n"))


def _with_bounds(counts: DataFrame, **aggs: Column) -> DataFrame:
    """Attach per-measure aggregates; that table has one row per measure, four at most."""
    return counts.join(F.broadcast(counts.groupBy("measure").agg(*[a.alias(n) for n, a in aggs.items()])), "measure")


def length_histogram(df: DataFrame, bins: int = 200) -> DataFrame:
    """Rows per equal-width bin and measure, empty bins left out; the last bin is closed."""
    counts = _with_bounds(measure_counts(df), lo=F.min("value"), hi=F.max("value"))
    position = F.floor((F.col("value") - F.col("lo")) * bins / F.greatest(F.col("hi") - F.col("lo"), F.lit(1)))
    return (
        counts.withColumn("bin", F.least(position, F.lit(bins - 1)).cast("bigint"))
        .groupBy("measure", "bin")
        .agg(F.sum("n").cast("bigint").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
        .select(
            "measure", "bin",
            F.round(F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins, 6).alias("bin_start"),
            "n",
        )
    )


def length_density(df: DataFrame, grid: int = 200) -> DataFrame:
    """Gaussian kernel density of each measure on ``grid`` points from minimum to maximum.

    Scott's bandwidth. The kernel sum runs over (value, count) pairs, so its cost follows the
    number of distinct lengths, not of rows, and it is exact.
    """
    counts = measure_counts(df)
    total = F.sum("n")
    mean = F.sum(F.col("value") * F.col("n")) / total
    spread = F.sum(F.col("value") * F.col("value") * F.col("n").cast("double"))
    bounds = _with_bounds(
        counts, lo=F.min("value"), hi=F.max("value"), total=total,
        sd=F.sqrt((spread - mean * mean * total) / (total - 1)),
    )
    h = F.col("sd") * F.pow(F.col("total"), F.lit(-0.2))
    points = bounds.where("sd > 0").select(
        "*", h.alias("h"), F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point")
    )
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / F.lit(float(grid - 1))
    kernel = F.col("n") * F.exp(-0.5 * F.pow((F.col("x") - F.col("value")) / F.col("h"), F.lit(2.0)))
    return (
        points.withColumn("x", x)
        .groupBy("measure", "point", "x", "total", "h")
        .agg(F.sum(kernel).alias("k"))
        .select(
            "measure", F.col("point").cast("bigint").alias("point"), F.round("x", 6).alias("x"),
            (F.col("k") / (F.col("total") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"),
        )
    )
