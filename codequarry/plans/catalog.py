"""One query per operator over the given tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, lexing, text
from ..operators import calls as source
from ..operators import curate, extract, leakage, links, neardup, pages, project, similarity, stats
from ..session import SETTINGS, scratch
from ..sources import ledger, readers, sinks
from . import views
from .views import documents, files, functions, licenses, literal_files, repos, table, view

QUERIES = {}


def query(fn):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        for key, value in SETTINGS.items():
            if spark.conf.isModifiable(key):
                spark.conf.set(key, value)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


# --- sources and sinks


@query
def scan_functions(spark, sf):
    return functions(spark, sf).select("id", "nwo", "path", "language", "docstring", "url", "function_sha")


@query
def repo_urls(spark, sf):
    return readers.repo_urls(view(spark, sf, "pages", views.REPO_LIST))


@query
def license_map(spark, sf):
    return curate.license_map(licenses(spark, sf))


@query
def load_splits(spark, sf):
    df = functions(spark, sf)
    parts = {s: df.where(F.col("split") == s).drop("split") for s in leakage.SPLITS}
    return leakage.load_splits(parts).select("split", "id", "nwo", "function_sha")


@query
def to_jsonl(spark, sf):
    df = functions(spark, sf).withColumns({
        "tokens": text.word_tokens("docstring"),
        "identifier": F.nullif("identifier", F.lit("")),
    })
    return df.select("id", sinks.json_line("id", "nwo", "identifier", "docstring", "tokens").alias("line"))


@query
def pending_units(spark, sf):
    units = documents(spark, sf).select("doc_id", "source")
    return curate.pending_units(units, table(spark, sf, "labels"), ["doc_id"])


# --- projections and filters


@query
def function_record(spark, sf):
    df = functions(spark, sf).withColumns({
        "docstring": F.concat(F.lit("  "), "docstring", F.lit("\n　")),
        "docstring_summary": text.docstring_summary("docstring"),
        "function_tokens": text.word_tokens("function"),
    })
    rows = project.function_record(df)
    listed = [c for c, t in rows.dtypes if t == "array<string>"]
    return rows.withColumns({c: F.array_join(c, " ") for c in listed})


@query
def source_url(spark, sf):
    df = functions(spark, sf)
    return df.select("id", project.source_url("nwo", "sha", "path", "start_row", "end_row").alias("url"))


@query
def function_sha(spark, sf):
    return functions(spark, sf).select("id", hashing.function_sha("docstring", "function").alias("function_sha"))


@query
def short_sha(spark, sf):
    return functions(spark, sf).select("id", hashing.short_sha("function_sha").alias("function_sha"))


@query
def join_topics(spark, sf):
    return project.join_topics(repos(spark, sf)).select("full_name", "stargazers_count", "topics")


@query
def remote_to_nwo(spark, sf):
    df = documents(spark, sf).selectExpr(
        "doc_id",
        "case doc_id % 5 when 0 then 'https://github.com/' || lang || '/' || source "
        "when 1 then 'https://github.com/' || lang || '/' || source || '.git' "
        "when 2 then 'https://gitee.com/' || lang || '/' || source || '.git' "
        "when 3 then 'http://gitee.com/' || lang || '/' || source "
        "else 'https://example.com/' || lang || '/' || source end as url",
    )
    return df.select("doc_id", project.remote_to_nwo("url").alias("nwo"))


@query
def path_to_nwo(spark, sf):
    nwo, inner = project.path_to_nwo("path")
    return files(spark, sf).select("file_id", nwo.alias("nwo"), inner.alias("inner_path"))


@query
def repo_key(spark, sf):
    df = documents(spark, sf).selectExpr(
        "doc_id",
        "case when doc_id % 2 = 0 then 'github' else 'gitee' end as site",
        "case doc_id % 5 when 0 then lang || '/' || source when 1 then lang || '##' || source "
        "when 2 then lang || '/' || source || '.git' when 3 then lang || '##' || source || '_arkts' "
        "else source end as name",
    )
    return df.select("doc_id", project.repo_key("name", "site").alias("repo"))


@query
def path_filter(spark, sf):
    return files(spark, sf).where(project.is_source_path("path")).select("file_id", "path")


@query
def min_tokens(spark, sf):
    df = functions(spark, sf).withColumn("tokens", text.word_tokens("docstring"))
    return df.where(project.has_min_tokens("tokens")).select("id", F.size("tokens").cast("bigint").alias("n_tokens"))


@query
def name_blacklist(spark, sf):
    df = documents(spark, sf).selectExpr(
        "doc_id",
        "case doc_id % 4 when 0 then 'toString' when 1 then 'valueOf' else 'fn' || cast(doc_id as string) end as identifier",
    )
    return df.where(project.has_allowed_name("identifier"))


@query
def size_limit(spark, sf):
    df = files(spark, sf).where(project.within_size("content", 2048))
    return df.select("file_id", F.octet_length("content").cast("bigint").alias("bytes"))


@query
def filter_docstring(spark, sf):
    kept = curate.filter_docstring(functions(spark, sf), ["id"])
    return kept.select("id", "docstring", F.md5("function").alias("function_md5"))


@query
def filter_license(spark, sf):
    allowed = curate.license_map(licenses(spark, sf))
    return curate.filter_license(functions(spark, sf), allowed).select("id", "source", "nwo")


@query
def license_flag(spark, sf):
    return curate.with_allowed_flag(view(spark, sf, "documents", views.LICENSES)).select("line_no", "license", "allowed")


@query
def extract_status(spark, sf):
    return extract.extract_status(files(spark, sf), extract.JSON_MAX_BYTES)


# --- joins and deduplication


@query
def enrich_repo(spark, sf):
    rows = curate.enrich(functions(spark, sf), repos(spark, sf))
    return rows.select("function_sha", "url", "nwo", "topics", "forks_count", "stargazers_count", "watchers")


@query
def dedup_functions(spark, sf):
    rows = curate.best_functions(curate.enrich(functions(spark, sf), repos(spark, sf)))
    return rows.select(
        "function_sha", "url", "nwo", "language", "path", "identifier", "docstring", "function", "ast_function",
        "topics", "forks_count", "stargazers_count", "watchers", "duplicate_count",
    )


@query
def duplicate_urls(spark, sf):
    return curate.duplicate_urls(curate.enrich(functions(spark, sf), repos(spark, sf)))


@query
def duplicate_lists(spark, sf):
    lists = curate.duplicate_lists(functions(spark, sf), page_size=2)
    return lists.select(
        "function_sha", "page", "first_url", F.element_at("duplicates", -1).alias("last_url"),
        F.size("duplicates").cast("bigint").alias("n"), F.array_join("duplicates", " ").alias("urls"),
    )


@query
def merge_datasets(spark, sf):
    records = functions(spark, sf).select("id", "nwo", "docstring", "function", "source", F.lit("()").alias("parameters"))
    turns = table(spark, sf, "conversations").selectExpr(
        "conv_id * 1000 + turn as id", "nullif(role, 'user') as docstring", "text as function", "turn as stars"
    )
    passages = table(spark, sf, "benchmark").selectExpr("item_id as id", "text as function")
    merged = curate.merge_datasets([records, turns, passages], ["id"], ["github", "gitee", "other"])
    return merged.select("id", "source", "nwo", "docstring", "function", "stars")


@query
def call_links(spark, sf):
    calls = view(spark, sf, "lineitem", views.CALLS)
    return links.call_links(calls, _imports(spark, sf), view(spark, sf, "part", views.DEFINITIONS))


def _callers(spark, sf) -> DataFrame:
    return view(spark, sf, "part", views.CALLERS)


def _resolved(spark, sf) -> DataFrame:
    apps = _callers(spark, sf)
    functions = extract.extract_functions(apps.select("file_id", "content"))
    return source.resolved_calls(source.source_calls(apps), source.source_imports(apps), functions)


@query
def source_calls(spark, sf):
    """Calls out of source, the function around each, and where each leads."""
    return _resolved(spark, sf).select(
        "file_id", "callee", "argument_list", F.col("start_row").cast("bigint").alias("start_row"), F.col("end_row").cast("bigint").alias("end_row"),
        "caller", "origin", F.coalesce("module", F.lit("")).alias("module"), F.coalesce("name", F.lit("")).alias("name"),
    )


@query
def source_imports(spark, sf):
    return source.source_imports(_callers(spark, sf))


@query
def source_call_links(spark, sf):
    """Calls and imports read out of source, linked to library definitions."""
    apps = _callers(spark, sf).select("file_id", "nwo", "sha", "path", "content")
    named = apps.drop("content").hint("merge")
    found = _resolved(spark, sf).withColumn("identifier", F.coalesce("name", "identifier")).join(named, "file_id")
    imports = source.source_imports(apps).join(named, "file_id").select("nwo", "path", links.library_of("module").alias("library")).distinct()
    return links.call_links(found, imports, view(spark, sf, "part", views.DEFINITIONS))


def _imports(spark, sf) -> DataFrame:
    """Every call's file imports the library of the part the call names, as a dotted context."""
    parts = table(spark, sf, "part").selectExpr("p_partkey as l_partkey", "lower(p_type) || '.api' as context")
    used = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(parts, "l_partkey")
    used = used.select("l_orderkey", "context").distinct()
    context = F.create_map(F.lit("as"), F.col("context"))
    return used.select(
        F.lit("orders/shop").alias("nwo"),
        F.concat(F.lit("order"), F.col("l_orderkey").cast("string"), F.lit(".ets")).alias("path"),
        F.explode(links.libraries_of(context)).alias("library"),
    )


# --- leakage


@query
def exact_dup_overlap(spark, sf):
    return leakage.exact_dup_overlap(functions(spark, sf))


@query
def cross_split_keys(spark, sf):
    return leakage.cross_split_keys(functions(spark, sf))


@query
def split_intersect(spark, sf):
    return leakage.split_intersect(functions(spark, sf), "function_sha", "train", "test")


@query
def split_repo_stats(spark, sf):
    return leakage.split_repo_stats(functions(spark, sf))


@query
def repo_contamination(spark, sf):
    return leakage.repo_contamination(functions(spark, sf))


@query
def top_overlap_repos(spark, sf):
    return leakage.top_overlap_repos(functions(spark, sf))


@query
def docstring_exact_overlap(spark, sf):
    return leakage.docstring_exact_overlap(functions(spark, sf))


@query
def docstring_fuzzy(spark, sf):
    return similarity.docstring_fuzzy(functions(spark, sf))


@query
def docstring_fuzzy_summary(spark, sf):
    return similarity.docstring_fuzzy_summary(functions(spark, sf))


@query
def top_fuzzy(spark, sf):
    return similarity.top_fuzzy(functions(spark, sf))


@query
def near_dup_pairs(spark, sf):
    return neardup.near_dup_pairs(functions(spark, sf))


@query
def near_dup_best(spark, sf):
    return neardup.near_dup_best(functions(spark, sf))


@query
def near_dup_summary(spark, sf):
    return neardup.near_dup_summary(functions(spark, sf))


@query
def top_near_dups(spark, sf):
    return neardup.top_near_dups(functions(spark, sf))


@query
def near_dup_sure(spark, sf):
    return neardup.near_dup_sure(functions(spark, sf), threshold=0.7)


@query
def near_dup_recall(spark, sf):
    """Over all test rows, not a sample of them."""
    return neardup.near_dup_recall(functions(spark, sf))


@query
def docstring_best(spark, sf):
    return similarity.docstring_best(functions(spark, sf))


@query
def near_dup_exact(spark, sf):
    return neardup.near_dup_exact(functions(spark, sf), threshold=0.7)


# --- statistics


@query
def dataset_stats(spark, sf):
    return stats.dataset_stats(functions(spark, sf))


@query
def source_counts(spark, sf):
    return stats.value_counts(functions(spark, sf), "source")


@query
def source_share(spark, sf):
    return stats.shares(functions(spark, sf), "source")


@query
def identifier_share(spark, sf):
    return stats.identifier_share(functions(spark, sf))


@query
def length_columns(spark, sf):
    return stats.length_columns(functions(spark, sf)).select("id", *stats.MEASURES, "has_identifier")


@query
def length_histogram(spark, sf):
    return stats.length_histogram(functions(spark, sf))


@query
def length_density(spark, sf):
    return stats.length_density(functions(spark, sf)).withColumn("density", F.round("density", 10))


@query
def top_repos(spark, sf):
    return stats.top_repos(functions(spark, sf))


@query
def resumed_rows(spark, sf):
    """Rows of all documents by two runs after one that was stopped before its manifest."""
    path = scratch(spark, "ledger")
    units = functions(spark, sf).select("nwo", "id", "function")

    def work(todo):
        return todo.select("nwo", "id", F.octet_length("function").cast("bigint").alias("n_bytes"))

    work(units).write.parquet(f"{path}/rows/run=stopped")
    ledger.resume(spark, path, units.where(F.crc32("nwo") % 2 == 0), ["nwo"], work)
    ledger.resume(spark, path, units, ["nwo"], work)
    return ledger.results(spark, path).select("nwo", "id", "n_bytes")


# --- what is written and read back

def _source_path():
    return F.concat(F.lit("src/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".ets"))


def _digests(files):
    return files.select("path", F.md5("content").alias("content_md5"))


@query
def read_source_parquet(spark, sf):
    """Raw sources through the parquet sink and its scan."""
    path = scratch(spark, "raw-parquet")
    sinks.write_parquet(documents(spark, sf).select(F.col("text").alias("content"), _source_path().alias("max_stars_repo_path")), path)
    return _digests(readers.source_parquet(spark, path))


@query
def read_source_json(spark, sf):
    """Raw sources as gzipped JSON, spread after reading."""
    path = scratch(spark, "raw-json")
    rows = documents(spark, sf).select(F.col("text").alias("content"), _source_path().alias("path"))
    rows.write.option("compression", "gzip").json(path)
    return _digests(readers.source_json(spark, path, partitions=spark.sparkContext.defaultParallelism))


@query
def read_source_jsonl(spark, sf):
    """Raw sources through the JSON lines sink and their scan."""
    path = scratch(spark, "raw-jsonl")
    sinks.write_by_extension(documents(spark, sf).select(F.col("text").alias("raw_text"), _source_path().alias("file_name")), f"{path}.json")
    return _digests(readers.source_jsonl(spark, f"{path}.json"))


@query
def read_tolerant_jsonl(spark, sf):
    """JSON lines among blank and broken ones."""
    path = scratch(spark, "tolerant")
    line = F.to_json(F.struct("doc_id", "text"))
    broken = F.when(F.col("doc_id") % 3 == 0, F.expr("left(line, 12)")).otherwise(F.lit("  "))
    lines = documents(spark, sf).select("doc_id", line.alias("line")).select(F.explode(F.array("line", broken)).alias("value"))
    lines.write.text(path)
    return readers.tolerant_jsonl(spark, path, "doc_id bigint, text string").select("doc_id", F.md5("text").alias("text_md5"))


@query
def read_repo_csv(spark, sf):
    """The repository list through the CSV sink and its scan."""
    path = scratch(spark, "repo-list")
    rows = table(spark, sf, "pages").select("page_id", "url", F.concat(F.lit('a "b", '), "url").alias("description"))
    sinks.write_csv(rows, path)
    return readers.repo_list_csv(spark, path).select(F.col("page_id").cast("bigint").alias("page_id"), "url", "description")


@query
def run_outcomes(spark, sf):
    """Rows written for either outcome of a run; a null outcome is a failure."""
    rows = documents(spark, sf).select("doc_id", F.when(F.col("doc_id") % 7 > 0, F.col("n_chars") > 500).alias("ok"))
    parts = zip(("success", "failure"), curate.success_and_failure(rows, F.col("ok")))
    counts = [(name, sinks.write_parquet(part, scratch(spark, f"outcome-{name}"))) for name, part in parts]
    return spark.createDataFrame(counts, "outcome string, n bigint")


@query
def supported_languages(spark, sf):
    named = F.when(F.col("doc_id") % 3 == 0, "ArkTS").when(F.col("doc_id") % 3 == 1, "arkts").otherwise(F.col("lang"))
    rows = documents(spark, sf).select("doc_id", named.alias("language"))
    return rows.where(project.is_supported_language("language"))


# --- text functions


@query
def docstring_tokens(spark, sf):
    toks = text.docstring_tokens(text.docstring_summary("text"))
    return documents(spark, sf).select(
        "doc_id", F.size(toks).cast("bigint").alias("n_tokens"), F.array_join(toks, " ").alias("tokens")
    )


@query
def word_tokens(spark, sf):
    return documents(spark, sf).select("doc_id", F.array_join(text.word_tokens("text"), " ").alias("tokens"))


@query
def flatten_tokens(spark, sf):
    lines = F.transform(F.split("text", "\n", -1), text.word_tokens)
    return documents(spark, sf).select(
        "doc_id", F.array_join(project.flatten_tokens(lines), " ").alias("tokens")
    )


@query
def shingles(spark, sf):
    df = documents(spark, sf).select("doc_id", text.shingles("text").alias("s"))
    return df.select("doc_id", F.size("s").cast("bigint").alias("n"), F.array_join(F.array_sort("s"), "|").alias("shingles"))


@query
def normalize_text(spark, sf):
    return documents(spark, sf).select("doc_id", text.normalize("text").alias("normalized"))


@query
def token_jaccard(spark, sf):
    return functions(spark, sf).select("id", F.round(text.token_jaccard("docstring", "function"), 9).alias("jaccard"))


@query
def pair_key(spark, sf):
    return functions(spark, sf).select("id", hashing.pair_key("docstring", "function").alias("pair_key"))


@query
def minhash_signature(spark, sf):
    df = documents(spark, sf).select("doc_id", "text").where(F.size(text.word_tokens("text")) > 0)
    df = hashing.with_minhash(df, hashing.shingle_hashes("text"), "s")
    return df.select("doc_id", F.array_join(F.col("s").cast("array<string>"), ",").alias("signature"))


@query
def strip_comment(spark, sf):
    df = documents(spark, sf).selectExpr(
        "doc_id", "'/** ' || replace(text, chr(10), chr(10) || '  * ') || ' */' as comment"
    )
    return df.select("doc_id", text.strip_comment("comment").alias("stripped"))


@query
def docstring_summary(spark, sf):
    df = documents(spark, sf).selectExpr(
        "doc_id",
        "case doc_id % 3 when 0 then replace(text, chr(10), chr(10) || chr(10)) "
        "when 1 then replace(text, '. ', ' @') else text end as docstring",
    )
    return df.select("doc_id", text.docstring_summary("docstring").alias("summary"))


@query
def license_comment(spark, sf):
    df = documents(spark, sf).selectExpr(
        "doc_id", "text || case when doc_id % 2 = 0 then ' Copyright' else '' end as comment"
    )
    return df.select("doc_id", text.is_license_comment("comment").alias("is_license"))


@query
def code_tokens(spark, sf):
    toks = lexing.code_tokens("content")
    return files(spark, sf).select("file_id", F.size(toks).cast("bigint").alias("n"), F.array_join(toks, " ").alias("tokens"))


@query
def extract_comments(spark, sf):
    found = lexing.comments_of("content")
    return files(spark, sf).select(
        "file_id", F.size(found).cast("bigint").alias("n"), F.array_join(found, "\n").alias("comments")
    )


@query
def remove_comments(spark, sf):
    return files(spark, sf).select("file_id", lexing.remove_comments("content").alias("code"))


# --- extraction


@query
def extract_functions(spark, sf):
    rows = extract.extract_functions(files(spark, sf))
    return rows.select(
        "file_id", "kind", "identifier", "parameters", "function",
        F.col("start_row").cast("bigint").alias("start_row"), F.col("start_col").cast("bigint").alias("start_col"),
        F.col("end_row").cast("bigint").alias("end_row"), F.col("end_col").cast("bigint").alias("end_col"),
    )


@query
def segmented_functions(spark, sf):
    """The same rows from files cut into segments, each chunk and segment in a task of its own."""
    rows = extract.extract_functions(files(spark, sf), split_above=1000)
    return rows.select(
        "file_id", "kind", "identifier", "parameters", "function",
        F.col("start_row").cast("bigint").alias("start_row"), F.col("start_col").cast("bigint").alias("start_col"),
        F.col("end_row").cast("bigint").alias("end_row"), F.col("end_col").cast("bigint").alias("end_col"),
    )


@query
def literal_functions(spark, sf):
    """Functions around regex literals, divisions and nested templates."""
    rows = extract.extract_functions(literal_files(spark, sf))
    return rows.select(
        "file_id", "kind", "identifier", "parameters", "function", F.col("start_row").cast("bigint").alias("start_row")
    )


@query
def literal_comments(spark, sf):
    found = lexing.comments_of("content")
    return literal_files(spark, sf).select(
        "file_id", F.array_join(found, "\n").alias("comments"), lexing.remove_comments("content").alias("code")
    )


@query
def attach_docstring(spark, sf):
    return extract.with_docstrings(files(spark, sf)).select("file_id", "identifier", "kind", "docstring")


@query
def obfuscate_tokens(spark, sf):
    rows = extract.with_text_forms(extract.extract_functions(files(spark, sf)))
    return rows.select(
        "file_id", "kind", "identifier", "obf_function", F.array_join("obf_function_tokens", " ").alias("obf_tokens")
    )


@query
def function_rows(spark, sf):
    """All 22 columns; lists joined by a blank."""
    return _lists_joined(extract.repository_rows(files(spark, sf)))


@query
def bulk_rows(spark, sf):
    """The 22 columns with type and place, of files within the bulk limit."""
    rows = extract.bulk_rows(files(spark, sf), extract.PARQUET_MAX_BYTES)
    rows = rows.withColumns({
        f"{p}_{c}": F.col(f"{p}_point.{c}").cast("bigint") for p in ("start", "end") for c in ("row", "col")
    })
    return _lists_joined(rows.drop("start_point", "end_point"))


def _lists_joined(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.array_join(c, " ") for c, t in rows.dtypes if t == "array<string>"})


# --- pages and payloads


@query
def page_fields(spark, sf):
    return pages.page_fields(table(spark, sf, "pages"))


@query
def listing_items(spark, sf):
    return pages.listing_items(view(spark, sf, "supplier", views.LISTINGS)).drop("item")


@query
def license_from_payload(spark, sf):
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "case when c_custkey % 2 = 0 then 'github' else 'gitee' end as site",
        "case c_custkey % 6 when 0 then to_json(named_struct('license', named_struct('spdx_id', c_mktsegment))) "
        "when 1 then to_json(named_struct('license', lower(c_mktsegment))) "
        "when 2 then '{\"license\": null}' "
        "when 3 then to_json(named_struct('license', '', 'spdx', lower(c_mktsegment))) "
        "when 4 then '{}' else '{\"message\": \"Not Found\"}' end as payload",
    )
    return df.select("c_custkey", pages.license_from_payload("payload", "site").alias("license"))


@query
def repos_from_payload(spark, sf):
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "to_json(named_struct('total_count', 2, 'items', array("
        "named_struct('full_name', c_name, 'stargazers_count', c_nationkey, 'language', c_mktsegment), "
        "named_struct('full_name', c_name || '-fork', 'stargazers_count', 0, 'language', null)))) as payload",
    )
    return pages.repos_from_payload(df)
