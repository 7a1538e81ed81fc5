"""The given tables seen through the library's data model.

Every view is a list of SQL expressions that Spark and DuckDB read alike, so a query and its
SQL counterpart start from the same rows.
"""

from pyspark.sql import DataFrame, SparkSession


NL = "chr(10)"
ID = "cast(doc_id as string)"
FIRST_LINE = f"split_part(text, {NL}, 1)"

# documents as functions: one row per document.
FUNCTIONS = {
    "id": "doc_id",
    "nwo": "source",
    "sha": "substr(md5(source), 1, 8)",
    "path": f"lang || '/' || {ID}",
    "language": "lang",
    "source": "lang",
    "identifier": "regexp_extract(text, '^([A-Za-z]+)', 1)",
    "docstring": FIRST_LINE,
    "function": "text",
    "ast_function": "translate(text, ' ', '#')",
    "start_row": "0",
    "end_row": f"length(text) - length(replace(text, {NL}, ''))",
    "url": (
        "'https://github.com/' || source || '/blob/' || substr(md5(source), 1, 8) || '/' || lang || '/' || "
        f"{ID} || '#L1-L' || cast(length(text) - length(replace(text, {NL}, '')) + 1 as string)"
    ),
    "function_sha": f"sha1({FIRST_LINE} || {NL} || text)",
    "split": "case doc_id % 11 when 10 then 'test' when 9 then 'validation' else 'train' end",
}

# documents as source files: each carries its whole text in comments of a small module.
_HEAD = (
    "case doc_id % 3 "
    f"when 0 then '// Copyright holders of ' || source || '. All under license terms.' || {NL} "
    f"when 1 then '// module ' || lang || {NL} || {NL} else '' end"
)
_DOC = (
    f"'/**' || {NL} || ' * ' || replace({FIRST_LINE}, '*/', '* /') || {NL} || ' * @param first value' || {NL} || ' */'"
)
_FUNCTION = (
    f"'export function fn' || {ID} || '(first: number, second: string): number {{' || {NL} || "
    f"'    // ' || replace(text, {NL}, {NL} || '    // ') || {NL} || "
    f"'    let total = first + ' || cast(n_chars as string) || {NL} || "
    f"'    if (total > ' || {ID} || ') {{ return total }}' || {NL} || "
    f"'    const note = \"open {{ brace in a string\"' || {NL} || "
    f"'    return second.length + total' || {NL} || '}}'"
).replace("{{", "{").replace("}}", "}")
_CONSTRUCTOR = "'constructor(size: number) { this.size = size }'"
_METHOD = (
    f"'size' || cast(doc_id % 100 as string) || '(limit: number): number {{' || {NL} || "
    f"'        return this.size * limit' || {NL} || '    }}'"
).replace("{{", "{").replace("}}", "}")
_TO_STRING = "'toString(): string { return `holder $' || '{this.size}` }'"
_ARROW = "'(a: number, b: number) => { return a - b }'"

FILES = {
    "file_id": "doc_id",
    "path": (
        "'/data/repos/' || lang || '/' || source || '/src/' || "
        f"case when doc_id % 7 = 0 then 'Test' else 'mod' end || {ID} || '.ets'"
    ),
    "sha": "substr(md5(source), 1, 8)",
    "content": (
        f"{_HEAD} || {_DOC} || {NL} || {_FUNCTION} || {NL} || {NL} || "
        f"'class Holder' || {ID} || ' {{' || {NL} || '    ' || {_CONSTRUCTOR} || {NL} || {NL} || "
        f"'    // size of ' || source || {NL} || '    ' || {_METHOD} || {NL} || '    ' || {_TO_STRING} || {NL} || '}}' || "
        f"{NL} || {NL} || 'const pick' || {ID} || ' = ' || {_ARROW} || {NL}"
    ).replace("{{", "{").replace("}}", "}"),
}

# documents as the text of a template in small files of regex literals, divisions and holes: the
# pieces between which functions begin and end.
_TICK, _SLASH = "chr(96)", "chr(92)"
_TEMPLATE_TEXT = f"replace(replace(replace(text, {_SLASH}, {_SLASH} || {_SLASH}), {_TICK}, {_SLASH} || {_TICK}), '$', {_SLASH} || '$')"
_INNER_ARROW = f"'q => {{ return ' || {_TICK} || '}}' || {_TICK} || ' + q }}'".replace("{{", "{").replace("}}", "}")
LITERAL_PARTS = {
    "classes": f"'function classes' || {ID} || '(s) {{ return s.replace(/[/*]+/g, \"\") }}'",
    "gap": f"' // half ' || {_TICK} || 'of it' || {NL} || 'let k = n / 2 / (n - 1) /* $' || '{{ */;' || {NL}",
    "outer": (
        f"'(x) => ' || {_TICK} || {_TEMPLATE_TEXT} || ' $' || '{{ [x].map(' || {_INNER_ARROW} || ').join(' || {_TICK} || '{{' || {_TICK} || ') }} y'"
        f" || {_TICK}"
    ),
    "inner": _INNER_ARROW,
    "hole": f"'function hole() {{ return ' || {_TICK} || '$' || '{{f(' || {_TICK} || '//x' || {_TICK} || ')}}' || {_TICK} || ' ; }}'",
    "tick": f"'function tick(s, n) {{ if (n) /' || {_TICK} || '/.test(s); return s.split(/[{{(' || chr(39) || ']/).length / 2 }}'",
}
LITERAL_PARTS = {k: v.replace("{{", "{").replace("}}", "}") for k, v in LITERAL_PARTS.items()}
LITERAL_FILES = {
    "file_id": "doc_id",
    "content": (
        f"{LITERAL_PARTS['classes']} || {LITERAL_PARTS['gap']} || 'const outer = ' || {LITERAL_PARTS['outer']} || {NL} || "
        f"{LITERAL_PARTS['hole']} || {NL} || {LITERAL_PARTS['tick']} || {NL}"
    ),
}

# documents with a licence line as licence records, in document order.
LICENSES = {
    "source": "lang",
    "repo": "source",
    "license": (
        "case when text like '%Apache License, Version 2.0%' then 'Apache-2.0' "
        "when text like '%MIT License%' then 'MIT' "
        "when text like '%GNU General Public License, version 3%' then 'GPL-3.0' "
        "when text like '%CC BY-NC 4.0%' then 'CC-BY-NC-4.0' end"
    ),
    "line_no": "doc_id",
}

# lineitem as calls: an order is a file, a part number decides what is called.
PART_NAME = (
    "case {k} % 10 when 0 then 'Widget' || cast({k} as string) when 1 then 'fn' || cast({k} % 1000 as string) "
    "when 2 then '_private' else 'make_part_' || cast({k} as string) end"
)
CALLS = {
    "nwo": "'orders/shop'",
    "sha": "substr(md5('shop'), 1, 8)",
    "path": "'order' || cast(l_orderkey as string) || '.ets'",
    "identifier": PART_NAME.format(k="l_partkey"),
    "argument_list": "'(' || cast(l_quantity as int) || ')'",
    "start_row": "l_linenumber * 1000 + l_suppkey",
    "end_row": "l_linenumber * 1000 + l_suppkey + cast(l_quantity as int)",
}
# part as library functions; a part type is a library.
DEFINITIONS = {
    "library": "lower(p_type)",
    "identifier": f"{PART_NAME.format(k='p_partkey')} || case when p_partkey % 10 = 0 then '.__init__' else '' end",
    "url": "'lib/' || lower(p_type) || '/' || cast(p_partkey as string)",
}

# part as applications: each imports a library, under another name for part of them, and calls it from
# nested functions, templates and behind a regex literal. $ and { apart, for holes.
_PART = "cast(p_partkey as string)"
_MADE = "'make_part_' || " + _PART
CALLERS = {
    "file_id": "p_partkey",
    "nwo": "'apps/shop' || cast(p_partkey % 50 as string)",
    "sha": "substr(md5('apps'), 1, 8)",
    "path": f"'app' || {_PART} || '.ets'",
    "content": (
        f"'import {{ ' || {_MADE} || ' as made, /* {{ */ other' || {_PART} || ' }} from \"' || lower(p_type) || '.core\"' || {NL} || "
        f"'import * as ns from \"tools\" // from \"no\"' || {NL} || "
        f"'function order' || {_PART} || '(n: number) {{' || {NL} || "
        f"'  // never(called)' || {NL} || "
        f"'  const t = ' || chr(96) || p_name || ' $' || '{{made(n, \"' || p_brand || '\")}} no(text)' || chr(96) || {NL} || "
        f"'  return ns.deep.run(list => {{ return helper(' || {NL} || '    list) }})' || {NL} || '}}' || {NL} || "
        f"'function helper(a) {{ return /no(/.test(a) || other' || {_PART} || '() }}' || {NL}"
    ).replace("{{", "{").replace("}}", "}"),
}

# pages as a repository list with blanks.
REPO_LIST = {
    "url": "case when page_id % 5 = 0 then '   ' else ' ' || split_part(url, '?', 1) || '  ' end",
}

# supplier as repository listing pages: one full item, one without a title, one bare.
_ITEM_NAME = "s_name || '/repo' || cast(s_suppkey as string)"
LISTINGS = {
    "page_id": "s_suppkey",
    "html": (
        "'<html><body><div class=\"items-head\">x</div><div class=\"item\"><h3><a class=\"title project-namespace-path\" "
        f"title=\" ' || {_ITEM_NAME} || ' \" href=\"/' || replace(s_name, '#', '-') || '\">t</a></h3>"
        "<div class=\"stars-count\" data-count=\"' || cast(s_nationkey as string) || '\">*</div>"
        "<div class=\"project-desc\" title=\"a &amp; b &lt;' || cast(s_suppkey as string) || '&gt;\">d</div>"
        "<a class=\"project-language\" title=\"TypeScript\">l</a></div>"
        "<div class=\"item\"><h3><a class=\"other\" title=\"no\" href=\"/no\">n</a></h3></div>"
        f"<div class=\"ui item\"><h3> <a href=\"/bare\" title=\"bare' || cast(s_suppkey as string) || '\" "
        "class=\"project-namespace-path title\">b</a></h3></div></body></html>'"
    ),
}


# The key by which a table of one or a few row groups is dealt out when read.
DEALT_BY = {"documents": "doc_id", "lineitem": "l_orderkey", "pages": "page_id"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table, read as it lies; only one too small to give each core a split is dealt out, so
    that small tests run in parallel and no large table moves for a projection."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    few = name in DEALT_BY and df.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    return df.repartition(DEALT_BY[name]) if few else df


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def view(spark: SparkSession, sf: str, name: str, exprs: dict[str, str]) -> DataFrame:
    return table(spark, sf, name).selectExpr(*[f"{e} as {n}" for n, e in exprs.items()])


def cte(name: str, source: str, exprs: dict[str, str], where: str = "") -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
    return f"{name} AS (SELECT {cols} FROM {source} {where})"


def functions(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "documents", FUNCTIONS)


def files(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "documents", FILES)


def literal_files(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "documents", LITERAL_FILES)


def licenses(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "documents", LICENSES).where("license is not null")


REPO_COLUMNS = (
    "'src' || cast(n_nationkey as string) as full_name",
    "n_regionkey = 0 as fork",
    "n_regionkey as forks",
    "cast(customers as int) as stargazers_count",
    "n_nationkey * 2 as watchers",
)


def repos(spark: SparkSession, sf: str) -> DataFrame:
    """nation as repositories, starred by customers; two thirds are listed twice, src3 not at all."""
    nation = table(spark, sf, "nation").where("n_nationkey <> 3")
    customers = table(spark, sf, "customer").groupBy("c_nationkey").count().selectExpr(
        "c_nationkey as n_nationkey", "count as customers"
    )
    starred = nation.join(customers, "n_nationkey", "left")
    older = starred.where("n_regionkey <> 2").selectExpr(
        "n_nationkey", "n_name", "n_regionkey", "customers - 1 as customers"
    )
    both = starred.select(*older.columns).unionAll(older)
    return both.selectExpr(*REPO_COLUMNS, "array(lower(n_name), 'r' || cast(n_regionkey as string)) as topics")


REPOS_CTE = """starred AS (
  SELECT n_nationkey, n_name, n_regionkey, customers
  FROM nation LEFT JOIN (SELECT c_nationkey, count(*) customers FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey
  WHERE n_nationkey <> 3
), repos AS (
  SELECT 'src' || n_nationkey AS full_name, n_regionkey AS forks, CAST(customers AS INTEGER) AS stargazers_count,
         n_nationkey * 2 AS watchers, lower(n_name) || ' r' || n_regionkey AS topics
  FROM starred
)"""
