"""Readers. All give explicit schemas and lazy DataFrames; nothing is inferred from data."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.leakage import load_splits
from ..operators.project import LANGUAGES

REPO_INFO_SCHEMA = (
    "full_name string, fork boolean, forks int, stargazers_count int, watchers int, topics array<string>"
)
REPO_LIST_SCHEMA = "full_name string, url string, stars int, description string, language string"
LICENSE_SCHEMA = "source string, repo string, license string, allowed boolean"
FUNCTION_SCHEMA = (
    "nwo string, sha string, path string, language string, identifier string, parameters string, "
    "argument_list string, return_statement string, imports array<string>, calls array<string>, "
    "local_calls array<string>, docstring string, docstring_summary string, "
    "docstring_tokens array<string>, function string, function_tokens array<string>, "
    "ast_function string, ast_function_tokens array<string>, obf_function string, "
    "obf_function_tokens array<string>, url string, function_sha string"
)


def functions_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FUNCTION_SCHEMA).parquet(path)


def _numbered(df: DataFrame) -> DataFrame:
    """Name and order lines: file, start of the split, position in the split.

    monotonically_increasing_id is taken at the scan, before any shuffle: a split read again
    yields the same numbers, and they rise along the split.
    """
    return df.withColumns({
        "source_file": F.col("_metadata.file_path"),
        "source_block": F.col("_metadata.file_block_start"),
        "source_line": F.monotonically_increasing_id(),
    })


LINE_ORDER = ["source_file", "source_block", "source_line"]


def _file_id() -> Column:
    return F.concat_ws("#", "source_file", F.col("source_block").cast("string"), F.col("source_line").cast("string"))


def _as_files(df: DataFrame, path_column: str, content_column: str) -> DataFrame:
    return df.select(
        _file_id().alias("file_id"), F.col(path_column).alias("path"), F.col(content_column).alias("content")
    )


def source_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Raw sources with content and max_stars_repo_path, as (file_id, path, content)."""
    df = spark.read.schema("content string, max_stars_repo_path string").parquet(path)
    return _as_files(_numbered(df), "max_stars_repo_path", "content")


def source_json(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Raw sources with content and path, JSON lines, gzipped or not.

    A gzip file is one task however large; give ``partitions`` to spread its rows afterwards.
    """
    df = spark.read.schema("content string, path string").json(path)
    df = _as_files(_numbered(df), "path", "content")
    return df.repartition(partitions, "file_id") if partitions else df


def source_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Raw sources with file_name and raw_text, JSON lines."""
    df = spark.read.schema("file_name string, raw_text string").json(path)
    return _as_files(_numbered(df), "file_name", "raw_text")


def tolerant_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines without the blank and the malformed ones, with their order columns."""
    df = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    # Numbering reads every column, so the parser sees whole lines before bad ones are dropped.
    return _numbered(df).where("_corrupt_record is null").drop("_corrupt_record")


def jsonl_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as they are: ``record``, a map from key to value of any type, and the lines' order.

    Every key is kept, and a key that is absent differs from one that is null. Blank lines and
    lines that hold no JSON object are left out.
    """
    lines = _numbered(spark.read.text(path))
    parsed = lines.withColumn("value", F.when(F.json_object_keys("value").isNotNull(), F.try_parse_json("value")))
    return parsed.where("value IS NOT NULL").select(
        F.col("value").cast("map<string,variant>").alias("record"), *LINE_ORDER
    )


def source_tree(spark: SparkSession, root: str, language: str = "arkts") -> DataFrame:
    """Source files under a folder by the language's extension. Undecodable files have null content:
    they give no functions and show up in the status of a run."""
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{LANGUAGES[language]}")
        .load(root)
    )
    decoded = F.try_validate_utf8(F.col("content").cast("string"))
    path = _local_path(F.col("path"))
    return df.select(path.alias("file_id"), path.alias("path"), decoded.alias("content"))


def _local_path(path: Column) -> Column:
    """Local paths without their scheme, as the other readers and callers write them."""
    return F.regexp_replace(path, r"\Afile:/*", "/")


def classified_files(spark: SparkSession, path: str, language: str) -> DataFrame:
    """(list_file, path) of the files of one language, out of JSON objects {language: [paths]}.

    There is one object per list file, and its paths are relative to the list file's folder, the
    checked-out repository; ``path`` has both, as ``source_tree`` gives paths.
    """
    text = spark.read.text(path, wholetext=True).select(
        _local_path(F.col("_metadata.file_path")).alias("list_file"),
        F.from_json("value", "map<string, array<string>>").alias("by_language"),
    )
    inside = text.select("list_file", F.explode(F.col("by_language")[language]).alias("inside"))
    folder = F.regexp_replace("list_file", r"[^/]*\z", "")
    return inside.select("list_file", F.when(F.col("inside").startswith("/"), F.col("inside")).otherwise(F.concat(folder, "inside")).alias("path"))


def repo_urls(rows: DataFrame) -> DataFrame:
    """Distinct, trimmed, non-blank urls of a repository list."""
    return rows.select(strip("url").alias("url")).where("url <> ''").distinct()


def repo_list_csv(spark: SparkSession, path: str) -> DataFrame:
    """Repository list with a header row; columns are found by name."""
    return spark.read.option("header", "true").csv(path)


def repo_info(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return spark.read.schema(REPO_INFO_SCHEMA).format(format).load(path)


def license_records(spark: SparkSession, path: str) -> DataFrame:
    """Licence records with ``line_no``, a value that orders them as written."""
    df = _numbered(spark.read.schema(LICENSE_SCHEMA).json(path))
    return df.withColumn("line_no", F.struct(*LINE_ORDER)).drop(*LINE_ORDER)


def splits(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Parquet folders root/<split> that exist, as one DataFrame with a split column."""
    conf = spark._jsc.hadoopConfiguration()
    parts = {}
    for name in names:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        if folder.getFileSystem(conf).exists(folder):
            parts[name] = spark.read.parquet(f"{root}/{name}")
    return load_splits(parts)
