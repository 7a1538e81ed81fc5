"""Writers. Each returns the number of rows it wrote, counted on the way, without a second pass."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    df, seen = _counted(df)
    df.write.mode(mode).option("compression", "gzip").parquet(path)
    return seen.get["rows"]


def json_line(*columns: str) -> Column:
    """One JSON object per row: nulls kept, arrays as lists, text unescaped."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    df, seen = _counted(df)
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return seen.get["rows"]


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """JSON lines of a column ``record``, a map from key to value of any type."""
    df, seen = _counted(df.select(F.to_json("record").alias("value")))
    df.write.mode(mode).text(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    df, seen = _counted(df)
    df.write.mode(mode).option("header", "true").csv(path)
    return seen.get["rows"]


def write_by_extension(df: DataFrame, path: str) -> int:
    """JSON lines for a name ending in .json, parquet otherwise."""
    return write_jsonl(df, path) if path.endswith(".json") else write_parquet(df, path)
