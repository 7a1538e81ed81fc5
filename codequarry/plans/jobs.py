"""End-to-end jobs: read, run operators, write. They return the number of rows written."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import curate, extract, leakage, neardup, segments, similarity, stats
from ..operators.project import function_record
from ..session import intermediates, written
from ..sources import ledger, readers, sinks


def deduplicate(spark: SparkSession, functions_dir: str, info_dir: str, output_dir: str) -> int:
    """Enriched best row per hash to output_dir/functions, duplicate urls to output_dir/duplicates."""
    enriched = curate.enrich(
        readers.functions_parquet(spark, functions_dir), readers.repo_info(spark, info_dir)
    )
    sinks.write_parquet(curate.duplicate_lists(enriched), f"{output_dir}/duplicates")
    return sinks.write_parquet(curate.best_functions(enriched), f"{output_dir}/functions")


def _extract(files: DataFrame, rows_of, output: str, mode: str, max_bytes: int | None = None) -> int:
    """Rows of the files' functions to ``output``, and each file's status next to it.

    What is found is written once to the shared folder; rows and status are both read from there.
    """
    with intermediates(files.sparkSession):
        # Without a limit files may be of any size; the long ones are cut between declarations.
        split_above = None if max_bytes else segments.CHUNK
        found = extract.extract_functions(extract.with_language(files), max_bytes, split_above)
        extracted = written(found, "extracted")
        sinks.write_parquet(extract.file_status(files, max_bytes, extracted), f"{output}_status", mode)
        return sinks.write_parquet(rows_of(extract.kept_rows(extracted)), output, mode)


def extract_parquet(spark: SparkSession, input_dir: str, output_dir: str | None = None) -> int:
    files = readers.source_parquet(spark, input_dir)
    return _extract(files, extract.placed_rows, output_dir or f"{input_dir}/parsed", "append", extract.PARQUET_MAX_BYTES)


def extract_json(spark: SparkSession, input_dir: str, output_dir: str | None = None) -> int:
    files = readers.source_json(spark, input_dir)
    return _extract(files, extract.placed_rows, output_dir or f"{input_dir}/parsed", "overwrite", extract.JSON_MAX_BYTES)


def extract_jsonl(spark: SparkSession, path: str, output: str) -> int:
    return sinks.write_by_extension(extract.function_rows(readers.source_jsonl(spark, path)), output)


def extract_path(spark: SparkSession, path: str, output: str, nwo: str = "", sha: str = "") -> int:
    """Function rows of one source file, or of all source files under a folder but test and
    dependency files."""
    files = readers.source_tree(spark, path).withColumns({"nwo": F.lit(nwo), "sha": F.lit(sha)})
    inside = F.substr(F.col("path"), F.lit(len(path.rstrip("/")) + 2))
    files = files.withColumn("path", inside).where(extract.is_source_path("path"))
    return sinks.write_by_extension(extract.function_rows(files), output)


def scan_repositories(
    spark: SparkSession, repos_dir: str, output_dir: str, shas: DataFrame | None = None,
    finished: DataFrame | None = None, classified: DataFrame | None = None,
) -> int:
    """Function rows of all checked-out repositories (owner/name folders) under a folder.

    ``shas`` (nwo, sha) names the checked-out commits; repositories in ``finished`` (nwo) are
    left out; ``classified`` (path), from ``readers.classified_files``, limits the files. Results
    are appended, each file's status next to them.
    """
    files = readers.source_tree(spark, repos_dir)
    if classified is not None:
        files = files.join(classified.select("path"), "path", "left_semi")
    inner = F.substr(F.col("path"), F.lit(len(repos_dir.rstrip("/")) + 2))
    files = files.withColumn("path", F.concat(F.lit("/data/repos/"), inner))
    nwo, _ = extract.path_to_nwo("path")
    files = files.withColumn("nwo", nwo)
    if finished is not None:
        files = curate.pending_units(files, finished, ["nwo"])
    if shas is not None:
        files = files.join(shas.select("nwo", "sha"), "nwo", "left")
    return _extract(extract.repository_files(files), function_record, output_dir, "append")


def resume_scan(spark: SparkSession, repos_dir: str, output_dir: str, shas: DataFrame | None = None) -> int:
    """``scan_repositories`` that may be stopped and run again: repositories whose rows are complete
    are passed over, and no row is there twice. ``ledger.results`` reads the rows."""
    files = readers.source_tree(spark, repos_dir)
    inner = F.substr(F.col("path"), F.lit(len(repos_dir.rstrip("/")) + 2))
    files = files.withColumn("path", F.concat(F.lit("/data/repos/"), inner))
    nwo, _ = extract.path_to_nwo("path")
    files = files.withColumn("nwo", nwo)
    if shas is not None:
        files = files.join(shas.select("nwo", "sha"), "nwo", "left")

    def work(todo: DataFrame) -> DataFrame:
        found = extract.extract_functions(extract.with_language(extract.repository_files(todo)), None, segments.CHUNK)
        return function_record(extract.kept_rows(found))

    return ledger.resume(spark, output_dir, files, ["nwo"], work)


def parquet_to_jsonl(spark: SparkSession, input_dir: str, output: str) -> int:
    return sinks.write_jsonl(spark.read.parquet(input_dir), output)


def filter_docstring(spark: SparkSession, path: str, output: str, deduplicate: bool = True) -> int:
    """JSON lines with a docstring, first per (docstring, function); all keys of a line are kept."""
    records = readers.jsonl_records(spark, path)
    return sinks.write_records(curate.filter_docstring_records(records, readers.LINE_ORDER, deduplicate), output)


def filter_license(spark: SparkSession, path: str, licenses: str, output: str) -> int:
    """JSON lines of repositories with an allowed licence; all keys of a line are kept."""
    allowed = curate.license_map(readers.license_records(spark, licenses))
    return sinks.write_records(curate.filter_license_records(readers.jsonl_records(spark, path), allowed), output)


def merge(
    spark: SparkSession, inputs: list[str], output: str,
    labels: list[str] | None = None, drop_keys=curate.DROPPED_KEYS,
) -> int:
    """Merge JSON-lines files, whatever keys their lines have."""
    sources = [readers.jsonl_records(spark, path) for path in inputs]
    return sinks.write_records(curate.merge_records(sources, readers.LINE_ORDER, labels, drop_keys), output)


def audit(splits: DataFrame, id_col: str = "id") -> dict[str, DataFrame]:
    """Every table of the leakage report."""
    return {
        "exact_duplicates": leakage.exact_dup_overlap(splits),
        "cross_split_hashes": leakage.cross_split_keys(splits),
        "split_repositories": leakage.split_repo_stats(splits),
        "repository_contamination": leakage.repo_contamination(splits),
        "top_overlapping_repositories": leakage.top_overlap_repos(splits),
        "docstring_exact": leakage.docstring_exact_overlap(splits),
        "docstring_fuzzy": similarity.docstring_fuzzy_summary(splits),
        "top_fuzzy_docstrings": similarity.top_fuzzy(splits),
        "near_duplicates": neardup.near_dup_summary(splits, id_col),
        "top_near_duplicates": neardup.top_near_dups(splits, id_col),
    }


def describe(df: DataFrame) -> dict[str, DataFrame]:
    """Every table behind the dataset's charts."""
    out = {
        "summary": stats.dataset_stats(df),
        "histogram": stats.length_histogram(df),
        "density": stats.length_density(df),
        "identifier_share": stats.identifier_share(df),
    }
    if "source" in df.columns:
        out["source_share"] = stats.shares(df, "source")
    if "nwo" in df.columns:
        out["top_repositories"] = stats.top_repos(df)
    return out
