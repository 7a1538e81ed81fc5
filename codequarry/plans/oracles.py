"""SQL that DuckDB runs over the same tables, stating each query's result plainly.

Where a query prunes, bands or walks windows, the SQL here compares everything with everything
or builds the expected answer from the view's own parts.
"""

from . import views
from .views import NL, cte

# Written out here, not imported: a wrong value in the library has to show.
NUM_PERM, PRIME = 128, 2147483647
BANDS = {0.5: (25, 5), 0.7: (14, 9), 0.8: (9, 13), 0.9: (5, 25)}
ALLOWED_LICENSES = (
    "0BSD", "ZLIB", "ISC", "BSD-3-CLAUSE", "BSD-2-CLAUSE", "APACHE-2.0", "Apache-2.0", "MIT", "LGPL-3.0",
    "LGPL-2.1", "EPL-1.0", "MULANPSL-2.0", "MulanPSL-2.0", "CC-BY-4.0", "MPL-2.0", "BSD-3-Clause", "Unlicense",
)

# Whitespace as an RE2 class, spelled out: RE2's \s is ASCII.
_WS = (
    r"[\t\n\v\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_WORD = "'[a-zA-Z0-9_]+'"
_DOC_TOKEN = (
    "'[^" + _WS[1:-1] + r""",''"`.():\[\]=*;>{}+\-./\\]+"""
    r"""|\\+|\.+|\(\)|\{\}|\[\]|\(+|\)+|:+|\[+|\]+|\{+|\}+|=+|\*+|;+|>+|\++|-+|/+'"""
)
_COMMENT = r"/\*(?:[^*]|\*+[^*/])*\*+/|//[^\n]*"
_STRING = r"""\"(?:[^\"\\\n]|\\(?s:.))*\"?|''(?:[^''\\\n]|\\(?s:.))*''?|`(?:[^`\\]|\\(?s:.))*`?"""
_CODE = (
    "'" + _COMMENT + "|" + _STRING + r"|[\p{L}_$][\p{L}\p{N}_$]*|[0-9][0-9A-Za-z_.]*|" + _WS + "+"
    r"|=>|\.\.\.|===|!==|\*\*|\+\+|--|&&|\|\||\?\?|\?\.|==|!=|<=|>=|[-+*/%&|^]=|(?s:.)'"
)


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{_WS}+|{_WS}+$', '', 'g')"


def norm(e: str) -> str:
    return f"regexp_replace(lower({strip(f'coalesce({e}, chr(0)[1:0])')}), '{_WS}+', ' ', 'g')".replace(
        "chr(0)[1:0]", "''"
    )


def words(e: str) -> str:
    return f"regexp_extract_all({e}, {_WORD})"


def summary(e: str) -> str:
    return (
        f"CASE WHEN contains({e}, {NL} || {NL}) THEN split_part({e}, {NL} || {NL}, 1) "
        f"WHEN contains({e}, '@') THEN split_part({e}, '@', 1) ELSE {e} END"
    )


def shingles(e: str) -> str:
    return (
        f"CASE WHEN len({e}) = 0 THEN []::VARCHAR[] WHEN len({e}) < 3 THEN [array_to_string({e}, '')] "
        f"ELSE list_distinct(list_transform(range(1, len({e}) - 1), "
        f"lambda i: {e}[i] || ' ' || {e}[i + 1] || ' ' || {e}[i + 2])) END"
    )


def jaccard(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return (
        f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0::DOUBLE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE "
        f"ELSE {both}::DOUBLE / (len({a}) + len({b}) - {both}) END"
    )


def strip_comment(e: str) -> str:
    line = strip("l")
    line = f"regexp_replace({line}, '[*]/$', '')"
    line = strip(f"regexp_replace({line}, '^(?:[*]|/[*][*]|//|/[*])', '')")
    return f"array_to_string(list_transform(string_split({e}, {NL}), lambda l: {line}), {NL})"


FN = cte("functions", "documents", views.FUNCTIONS)
FILES = cte("files", "documents", views.FILES)
LICENSES = (
    f"{cte('raw_licenses', 'documents', views.LICENSES)}, "
    "licenses AS (SELECT * FROM raw_licenses WHERE license IS NOT NULL)"
)
LICENSE_MAP = (
    "license_map AS (SELECT source, repo, license FROM (SELECT *, row_number() OVER "
    "(PARTITION BY source, repo ORDER BY line_no DESC) rn FROM licenses) WHERE rn = 1)"
)
ALLOWED = ", ".join(f"'{x}'" for x in ALLOWED_LICENSES)
ENRICHED = f"""{FN}, {views.REPOS_CTE}, enriched AS (
  SELECT substr(function_sha, 1, 32) AS function_sha, url, nwo, language, path, identifier, docstring, function,
         ast_function, topics, forks AS forks_count, stargazers_count, watchers
  FROM functions LEFT JOIN repos ON nwo = full_name)"""

PAIRS = "(VALUES ('train', 'validation'), ('train', 'test'), ('validation', 'test')) p(split_a, split_b)"

DOCSTRINGS = f"""{FN}, d AS (
  SELECT DISTINCT split, {norm('docstring')} AS docstring FROM functions WHERE split IN ('train', 'test')
), t AS (
  SELECT split, docstring, list_distinct({words('docstring')}) AS toks FROM d WHERE docstring <> ''
), sims AS (
  SELECT a.docstring AS test_docstring, b.docstring AS train_docstring, {jaccard('a.toks', 'b.toks')} AS similarity
  FROM t a, t b WHERE a.split = 'test' AND b.split = 'train' AND len(a.toks) > 0 AND len(b.toks) > 0
), fuzzy AS (
  SELECT test_docstring, train_docstring, similarity FROM (
    SELECT *, row_number() OVER (PARTITION BY test_docstring ORDER BY similarity DESC, train_docstring) rn FROM sims
  ) WHERE rn = 1 AND similarity >= 0.7
)"""

CONTENTS = f"""{FN}, tokens AS (
  SELECT id, split, {words('function')} AS toks FROM functions WHERE split IN ('train', 'test')
), contents AS (
  SELECT md5(array_to_string(toks, ' ')) AS key, any_value(toks) AS toks,
         min(id) FILTER (split = 'test') AS test_id, min(id) FILTER (split = 'train') AS train_id,
         count(*) FILTER (split = 'test') AS n_test, count(*) FILTER (split = 'train') AS n_train
  FROM tokens GROUP BY 1 HAVING len(any_value(toks)) > 0
), shingled AS (SELECT *, {shingles('toks')} AS sh FROM contents)"""

_HASH = f"('0x' || substr(md5(s), 1, 8))::BIGINT % {PRIME}"
_PERM = f"""perm AS (
  SELECT i, ('0x' || substr(md5('a' || i), 1, 8))::BIGINT % {PRIME - 1} + 1 AS a,
         ('0x' || substr(md5('b' || i), 1, 8))::BIGINT % {PRIME} AS b
  FROM range({NUM_PERM}) r(i))"""
_BANDINGS = ", ".join(f"({t}::DOUBLE, {b}, {r})" for t, (b, r) in BANDS.items())
LSH = f"""{CONTENTS}, {_PERM}, hashes AS (
  SELECT key, {_HASH} AS h FROM (SELECT key, unnest(sh) AS s FROM shingled)
), sig AS (
  SELECT key, i, min((a * h + b) % {PRIME}) AS m FROM hashes, perm GROUP BY key, i
), bands AS (
  SELECT threshold, key, i // n_rows AS band, string_agg(m, ',' ORDER BY i) AS bucket
  FROM sig, (VALUES {_BANDINGS}) v(threshold, n_bands, n_rows) WHERE i < n_bands * n_rows GROUP BY 1, 2, 3
), cand AS (
  SELECT DISTINCT threshold, te.key AS test_key, tr.key AS train_key
  FROM bands te JOIN bands tr USING (threshold, band, bucket)
  JOIN contents ct ON ct.key = te.key AND ct.n_test > 0 JOIN contents cr ON cr.key = tr.key AND cr.n_train > 0
), keys AS (SELECT DISTINCT test_key, train_key FROM cand
), estimate AS (
  SELECT test_key, train_key, count(*) FILTER (x.m = y.m) / {float(NUM_PERM)}::DOUBLE AS similarity
  FROM keys JOIN sig x ON x.key = test_key JOIN sig y ON y.key = train_key AND y.i = x.i GROUP BY 1, 2
), lsh AS (
  SELECT threshold, test_key, train_key, similarity, ct.test_id, cr.train_id, ct.n_test, cr.n_train
  FROM cand JOIN estimate USING (test_key, train_key)
  JOIN contents ct ON ct.key = test_key JOIN contents cr ON cr.key = train_key
)"""

# Bands for a recall of 0.98 at the threshold, and what they find of the exact pairs.
_SURE = "(0.7::DOUBLE, 25, 5), (0.8::DOUBLE, 18, 7), (0.9::DOUBLE, 11, 11)"
SURE = f"""{CONTENTS}, {_PERM}, sets AS (
  SELECT array_to_string(list_sort(sh), '|') AS k, any_value(sh) AS sh, min(test_id) AS test_id, min(train_id) AS train_id,
         sum(n_test)::BIGINT AS n_test, sum(n_train)::BIGINT AS n_train FROM shingled GROUP BY 1
), hashes AS (SELECT k, {_HASH} AS h FROM (SELECT k, unnest(sh) AS s FROM sets)
), sig AS (SELECT k, i, min((a * h + b) % {PRIME}) AS m FROM hashes, perm GROUP BY k, i
), bands AS (
  SELECT threshold, k, i // n_rows AS band, string_agg(m, ',' ORDER BY i) AS bucket
  FROM sig, (VALUES {_SURE}) v(threshold, n_bands, n_rows) WHERE i < n_bands * n_rows GROUP BY 1, 2, 3
), met AS (
  SELECT DISTINCT threshold, te.k AS test_k, tr.k AS train_k
  FROM (SELECT * FROM bands WHERE k IN (SELECT k FROM sets WHERE n_test > 0)) te
  JOIN (SELECT * FROM bands WHERE k IN (SELECT k FROM sets WHERE n_train > 0)) tr USING (threshold, band, bucket)
), sim AS (
  SELECT a.k AS test_k, b.k AS train_k, a.test_id, b.train_id, a.n_test AS test_rows, b.n_train AS train_rows, {jaccard('a.sh', 'b.sh')} AS similarity
  FROM sets a, sets b WHERE a.n_test > 0 AND b.n_train > 0
    AND least(len(a.sh), len(b.sh)) >= 0.69 * greatest(len(a.sh), len(b.sh)))"""

# Expected functions of the files view, from its parts.
_HEAD_ROWS = "CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END"
_LINES = f"(length(text) - length(replace(text, {NL}, '')))"
_FN_ROW = f"({_HEAD_ROWS} + 4)"
_AFTER = f"({_FN_ROW} + {_LINES} + 6)"
_FIRST = strip(f"replace({views.FIRST_LINE}, '*/', '* /')")
_DOCSTRING = (
    f"CASE doc_id % 3 WHEN 1 THEN 'module ' || lang || ' ' ELSE '' END || {NL} || {_FIRST} || {NL} "
    f"|| '@param first value' || {NL}"
)
FOUND = f"""found AS (
  SELECT doc_id AS file_id, 'export' AS kind, 'fn' || doc_id AS identifier, '(first: number, second: string)' AS parameters,
         {views._FUNCTION} AS function, {_DOCSTRING} AS docstring, {_FN_ROW} AS start_row, 0 AS start_col FROM documents
  UNION ALL SELECT doc_id, 'constructor', 'constructor', '(size: number)', {views._CONSTRUCTOR}, '', {_AFTER} + 3, 4 FROM documents
  UNION ALL SELECT doc_id, 'method', 'size' || doc_id % 100, '(limit: number)', {views._METHOD}, 'size of ' || source, {_AFTER} + 6, 4 FROM documents
  UNION ALL SELECT doc_id, 'method', 'toString', '()', {views._TO_STRING}, '', {_AFTER} + 9, 4 FROM documents
  UNION ALL SELECT doc_id, 'arrow', '', '(a: number, b: number)', {views._ARROW}, '', {_AFTER} + 12, 13 + length(doc_id::VARCHAR) FROM documents
), placed AS (
  SELECT *, start_row + length(function) - length(replace(function, {NL}, '')) AS end_row,
         length(string_split(function, {NL})[-1])
           + CASE WHEN contains(function, {NL}) THEN 0 ELSE start_col END AS end_col
  FROM found)"""

_OBF = f"""
  SELECT doc_id AS file_id, 'export' AS kind, 'fn' || doc_id AS identifier,
    'export function fn' || doc_id || '(arg_0: number, arg_1: string): number {{' || {NL}
      || repeat('    ' || {NL}, {_LINES} + 1)
      || '    let arg_2 = arg_0 + ' || n_chars || {NL} || '    if (arg_2 > ' || doc_id || ') {{ return arg_2 }}' || {NL}
      || '    const arg_3 = "open {{ brace in a string"' || {NL} || '    return arg_1.length + arg_2' || {NL} || '}}' AS obf_function,
    'export function fn' || doc_id || ' ( arg_0 : number , arg_1 : string ) : number {{ let arg_2 = arg_0 + ' || n_chars
      || ' if ( arg_2 > ' || doc_id || ' ) {{ return arg_2 }} const arg_3 = "open {{ brace in a string" return arg_1 . length + arg_2 }}' AS obf_tokens
  FROM documents
  UNION ALL SELECT doc_id, 'constructor', 'constructor', 'constructor(arg_0: number) {{ this.size = arg_0 }}',
    'constructor ( arg_0 : number ) {{ this . size = arg_0 }}' FROM documents
  UNION ALL SELECT doc_id, 'method', 'size' || doc_id % 100,
    'size' || doc_id % 100 || '(arg_0: number): number {{' || {NL} || '        return this.size * arg_0' || {NL} || '    }}',
    'size' || doc_id % 100 || ' ( arg_0 : number ) : number {{ return this . size * arg_0 }}' FROM documents
  UNION ALL SELECT doc_id, 'method', 'toString', {views._TO_STRING},
    'toString ( ) : string {{ return `holder $' || '{{this.size}}` }}' FROM documents
  UNION ALL SELECT doc_id, 'arrow', '', '(arg_0: number, arg_1: number) => {{ return arg_0 - arg_1 }}',
    '( arg_0 : number , arg_1 : number ) => {{ return arg_0 - arg_1 }}' FROM documents
""".replace("{{", "{").replace("}}", "}")

# The five calls of each application.
_APP_CALLS = f"""WITH apps AS (SELECT p_partkey AS file_id, 'apps/shop' || p_partkey % 50 AS nwo, substr(md5('apps'), 1, 8) AS sha,
    'app' || p_partkey || '.ets' AS path, split_part(lower(p_type), '.', 1) AS library FROM part), found AS (
  SELECT p_partkey AS file_id, 'make_part_' || p_partkey AS identifier, 'made' AS callee, '(n, "' || p_brand || '")' AS argument_list,
    4::BIGINT AS start_row, 4::BIGINT AS end_row, 'order' || p_partkey AS caller, 'imported' AS origin, lower(p_type) || '.core' AS module,
    'make_part_' || p_partkey AS name FROM part
  UNION ALL SELECT p_partkey, 'run', 'ns.deep.run', '(list => {{ return helper(' || {NL} || '    list) }})', 5, 6, 'order' || p_partkey, 'imported', 'tools', 'run' FROM part
  UNION ALL SELECT p_partkey, 'helper', 'helper', '(' || {NL} || '    list)', 5, 6, 'list', 'local', '', '' FROM part
  UNION ALL SELECT p_partkey, 'test', '.test', '(a)', 8, 8, 'helper', 'other', '', '' FROM part
  UNION ALL SELECT p_partkey, 'other' || p_partkey, 'other' || p_partkey, '()', 8, 8, 'helper', 'imported', lower(p_type) || '.core', 'other' || p_partkey FROM part
)""".replace("{{", "{").replace("}}", "}")

_PART = views.LITERAL_PARTS
_TEXT_LINES = f"length(text) - length(replace(text, {NL}, ''))"

# All columns of the extracted rows, from the same parts.
ROWS = f"""{FOUND}, {FILES}, obf AS ({_OBF}), found_rows AS (
  SELECT p.file_id, p.kind, d.lang, d.source, '' AS nwo, f.sha, f.path, 'arkts' AS language, p.identifier, p.parameters,
    '' AS argument_list, '' AS return_statement, '' AS imports, '' AS calls, '' AS local_calls,
    {strip('p.docstring')} AS docstring, {strip(summary('p.docstring'))} AS docstring_summary,
    array_to_string(regexp_extract_all({strip(summary('p.docstring'))}, {_DOC_TOKEN}), ' ') AS docstring_tokens,
    {strip('p.function')} AS function,
    array_to_string(list_filter(regexp_extract_all(p.function, {_CODE}), lambda x: NOT regexp_matches(x, '^{_WS}')), ' ') AS function_tokens,
    '' AS ast_function, '' AS ast_function_tokens, {strip('o.obf_function')} AS obf_function, o.obf_tokens AS obf_function_tokens,
    'https://github.com//blob/' || f.sha || '/' || f.path || '#L' || (p.start_row + 1) || '-L' || (p.end_row + 1) AS url,
    sha1({strip('p.docstring')} || {NL} || {strip('p.function')}) AS function_sha,
    p.start_row, p.start_col, p.end_row, p.end_col, strlen(f.content) AS content_bytes
  FROM placed p JOIN documents d ON d.doc_id = p.file_id JOIN files f ON f.file_id = p.file_id
  JOIN obf o ON o.file_id = p.file_id AND o.kind = p.kind AND o.identifier = p.identifier
  WHERE p.identifier <> 'toString'
)"""

MEASURED = f"""{FN}, lengths AS (
  SELECT id, CASE WHEN coalesce(function, '') = '' THEN 0 ELSE len(string_split(function, {NL})) END::INTEGER AS function_lines,
         CASE WHEN coalesce(docstring, '') = '' THEN 0 ELSE length(docstring) END::INTEGER AS docstring_len,
         CASE WHEN coalesce(function, '') = '' THEN 0 ELSE length(function) END::INTEGER AS function_len,
         CASE WHEN coalesce(ast_function, '') = '' THEN 0 ELSE len(string_split(ast_function, '#')) END::INTEGER AS ast_len,
         coalesce(identifier, '') <> '' AS has_identifier
  FROM functions
), measures AS (
  SELECT 'function_lines' AS measure, function_lines::BIGINT AS value FROM lengths
  UNION ALL SELECT 'docstring_len', docstring_len FROM lengths
  UNION ALL SELECT 'function_len', function_len FROM lengths
  UNION ALL SELECT 'ast_len', ast_len FROM lengths
)"""


def _share(column: str, source: str) -> str:
    return (
        f"SELECT {column}, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1)::DOUBLE AS pct "
        f"FROM {source} GROUP BY 1"
    )


ORACLES = {
    "scan_functions": f"WITH {FN} SELECT id, nwo, path, language, docstring, url, function_sha FROM functions",
    "repo_urls": f"WITH {cte('r', 'pages', views.REPO_LIST)} SELECT DISTINCT trim(url) AS url FROM r WHERE trim(url) <> ''",
    "license_map": f"WITH {LICENSES}, {LICENSE_MAP} SELECT * FROM license_map",
    "load_splits": f"WITH {FN} SELECT split, id, nwo, function_sha FROM functions",
    "to_jsonl": (
        f"WITH {FN} SELECT id, to_json({{'id': id, 'nwo': nwo, 'identifier': nullif(identifier, ''), "
        f"'docstring': docstring, 'tokens': {words('docstring')}}})::VARCHAR AS line FROM functions"
    ),
    "pending_units": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "function_record": f"""WITH {FN}, r AS (SELECT *, '  ' || docstring || {NL} || '　' AS doc2 FROM functions)
SELECT nwo, sha, path, language, identifier, '' AS parameters, '' AS argument_list, '' AS return_statement, '' AS imports,
  '' AS calls, '' AS local_calls, {strip('doc2')} AS docstring, {strip(summary('docstring'))} AS docstring_summary,
  array_to_string(regexp_extract_all({summary('docstring')}, {_DOC_TOKEN}), ' ') AS docstring_tokens,
  {strip('function')} AS function, array_to_string({words('function')}, ' ') AS function_tokens,
  {strip('ast_function')} AS ast_function, '' AS ast_function_tokens, '' AS obf_function, '' AS obf_function_tokens, url,
  sha1({strip('doc2')} || {NL} || {strip('function')}) AS function_sha FROM r""",
    "source_url": f"WITH {FN} SELECT id, url FROM functions",
    "function_sha": f"WITH {FN} SELECT id, sha1(docstring || {NL} || function) AS function_sha FROM functions",
    "short_sha": f"WITH {FN} SELECT id, substr(function_sha, 1, 32) AS function_sha FROM functions",
    "join_topics": (
        f"WITH {views.REPOS_CTE} SELECT full_name, stargazers_count, topics FROM repos UNION ALL "
        "SELECT full_name, stargazers_count - 1, topics FROM repos WHERE forks <> 2"
    ),
    "remote_to_nwo": "SELECT doc_id, CASE WHEN doc_id % 5 < 4 THEN lang || '/' || source END AS nwo FROM documents",
    "path_to_nwo": f"""WITH {FILES} SELECT file_id, split_part(path, '/', 4) || '/' || split_part(path, '/', 5) AS nwo,
  split_part(path, '/', 6) || '/' || split_part(path, '/', 7) AS inner_path FROM files""",
    "repo_key": """SELECT doc_id, CASE
  WHEN doc_id % 5 IN (0, 2) THEN lang || '/' || source
  WHEN doc_id % 5 IN (1, 3) AND doc_id % 2 = 1 THEN lang || '/' || source END AS repo FROM documents""",
    "path_filter": f"WITH {FILES} SELECT file_id, path FROM files WHERE NOT contains(lower(path), 'test') AND NOT contains(lower(path), 'node_modules')",
    "min_tokens": f"WITH {FN} SELECT id, len({words('docstring')}) AS n_tokens FROM functions WHERE len({words('docstring')}) > 1",
    "name_blacklist": "SELECT doc_id, 'fn' || doc_id AS identifier FROM documents WHERE doc_id % 4 > 1",
    "size_limit": f"WITH {FILES} SELECT file_id, strlen(content) AS bytes FROM files WHERE strlen(content) <= 2048",
    "filter_docstring": f"""WITH {FN} SELECT min(id) AS id, docstring, md5(function) AS function_md5
  FROM functions WHERE docstring <> '' GROUP BY docstring, function""",
    "filter_license": f"""WITH {FN}, {LICENSES}, {LICENSE_MAP}
SELECT id, f.source, nwo FROM functions f JOIN license_map m ON m.source = f.source AND m.repo = f.nwo WHERE license IN ({ALLOWED})""",
    "license_flag": f"WITH {LICENSES} SELECT line_no, license, coalesce(license IN ({ALLOWED}), false) AS allowed FROM raw_licenses",
    "extract_status": f"""WITH {FILES} SELECT CASE WHEN strlen(content) > {2**15} THEN 'too_large' ELSE 'ok' END AS status,
  count(*) AS files FROM files GROUP BY 1""",
    "enrich_repo": f"WITH {ENRICHED} SELECT function_sha, url, nwo, topics, forks_count, stargazers_count, watchers FROM enriched",
    "dedup_functions": f"""WITH {ENRICHED} SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY function_sha ORDER BY stargazers_count DESC NULLS LAST, url, path) AS rn,
         count(url) OVER (PARTITION BY function_sha) AS duplicate_count FROM enriched) WHERE rn = 1""",
    "duplicate_urls": f"WITH {ENRICHED} SELECT function_sha, url AS duplicate_url FROM enriched",
    "duplicate_lists": f"""WITH {FN}, r AS (
  SELECT function_sha, url, (row_number() OVER (PARTITION BY function_sha ORDER BY url) - 1) // 2 AS page FROM functions WHERE url IS NOT NULL)
SELECT function_sha, page, min(url) AS first_url, max(url) AS last_url, count(*) AS n, string_agg(url, ' ' ORDER BY url) AS urls
FROM r GROUP BY 1, 2""",
    "merge_datasets": f"""WITH u AS (
  SELECT 0 AS o, doc_id AS id, 'github' AS source, source AS nwo, {views.FIRST_LINE} AS docstring, text AS function,
         NULL::BIGINT AS stars, {views.FIRST_LINE} AS k FROM documents
  UNION ALL SELECT 1, conv_id * 1000 + turn, 'gitee', NULL, nullif(role, 'user'), text, turn, nullif(role, 'user') FROM conversations
  UNION ALL SELECT 2, item_id, 'other', NULL, NULL, text, NULL, '' FROM benchmark
), r AS (SELECT *, row_number() OVER (PARTITION BY k, function ORDER BY o, id) AS rn FROM u)
SELECT id, source, nwo, docstring, function, stars FROM r WHERE rn = 1""",
    "call_links": f"""WITH {cte('calls', 'lineitem', views.CALLS)}, {cte('definitions', 'part', views.DEFINITIONS)}, imports AS (
  SELECT DISTINCT 'order' || l_orderkey || '.ets' AS path, lower(p_type) AS library FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT c.nwo, c.sha, c.path, c.identifier, c.argument_list,
  'https://github.com/' || c.nwo || '/blob/' || c.sha || '/' || c.path || '#L' || (start_row + 1) || '-L' || (end_row + 1) AS call_url,
  d.url AS definition_url
FROM calls c JOIN imports i ON i.path = c.path JOIN (
  SELECT library, url, replace(identifier, '.__init__', '') AS answers_to FROM definitions WHERE identifier LIKE '%.\\_\\_init\\_\\_' ESCAPE '\\'
  UNION ALL SELECT library, url, identifier FROM definitions
  WHERE length(identifier) > 9 OR (NOT starts_with(identifier, '_') AND contains(identifier, '_'))
) d ON d.library = i.library AND d.answers_to = c.identifier""",
    "source_calls": f"""{_APP_CALLS} SELECT * EXCLUDE (identifier) FROM found""",
    "source_imports": """
  SELECT p_partkey AS file_id, lower(p_type) || '.core' AS module, 'make_part_' || p_partkey AS name, 'made' AS alias FROM part
  UNION ALL SELECT p_partkey, lower(p_type) || '.core', 'other' || p_partkey, 'other' || p_partkey FROM part
  UNION ALL SELECT p_partkey, 'tools', '*', 'ns' FROM part""",
    "source_call_links": f"""{_APP_CALLS}, {cte('definitions', 'part', views.DEFINITIONS)}
SELECT a.nwo, a.sha, a.path, c.identifier, c.argument_list,
  'https://github.com/' || a.nwo || '/blob/' || a.sha || '/' || a.path || '#L' || (start_row + 1) || '-L' || (end_row + 1) AS call_url, d.url AS definition_url
FROM found c JOIN apps a USING (file_id) JOIN (
  SELECT library, url, replace(identifier, '.__init__', '') AS answers_to FROM definitions WHERE identifier LIKE '%.\\_\\_init\\_\\_' ESCAPE '\\'
  UNION ALL SELECT library, url, identifier FROM definitions
  WHERE length(identifier) > 9 OR (NOT starts_with(identifier, '_') AND contains(identifier, '_'))
) d ON d.answers_to = c.identifier AND d.library IN (a.library, 'tools')""",
    "exact_dup_overlap": f"""WITH {FN}, k AS (
  SELECT split, coalesce(function_sha, '') AS sha, md5({norm('docstring')} || '|||' || {norm('function')}) AS pk FROM functions)
SELECT split_a, split_b,
  (SELECT count(*) FROM (SELECT sha FROM k WHERE split = split_a INTERSECT SELECT sha FROM k WHERE split = split_b)) AS sha_overlap,
  (SELECT count(*) FROM (SELECT pk FROM k WHERE split = split_a INTERSECT SELECT pk FROM k WHERE split = split_b)) AS pair_overlap
FROM {PAIRS}""",
    "cross_split_keys": f"""WITH {FN} SELECT coalesce(function_sha, '') AS function_sha, count(DISTINCT split) AS splits
FROM functions GROUP BY 1 HAVING count(DISTINCT split) > 1""",
    "split_intersect": f"""WITH {FN} SELECT function_sha FROM functions WHERE split = 'train'
INTERSECT SELECT function_sha FROM functions WHERE split = 'test'""",
    "split_repo_stats": f"WITH {FN} SELECT split, count(DISTINCT nullif(nwo, '')) AS repos, count(*) AS samples FROM functions GROUP BY 1",
    "repo_contamination": f"""WITH {FN}, c AS (SELECT split, nwo, count(*) AS n FROM functions WHERE nwo <> '' GROUP BY 1, 2), x AS (
  SELECT split_a, split_b, (SELECT count(*) FROM c a JOIN c b USING (nwo) WHERE a.split = split_a AND b.split = split_b) AS overlap_repos,
    (SELECT count(*) FROM c WHERE split = split_b) AS repos_b,
    (SELECT coalesce(sum(b.n), 0)::BIGINT FROM c a JOIN c b USING (nwo) WHERE a.split = split_a AND b.split = split_b) AS samples_affected,
    (SELECT count(*) FROM functions WHERE split = split_b) AS samples_b FROM {PAIRS})
SELECT *, round(coalesce(overlap_repos * 100.0::DOUBLE / nullif(repos_b, 0), 0), 6) AS pct_repos,
  round(coalesce(samples_affected * 100.0::DOUBLE / nullif(samples_b, 0), 0), 6) AS pct_samples FROM x""",
    "top_overlap_repos": f"""WITH {FN}, c AS (SELECT split, nwo, count(*) AS n FROM functions WHERE nwo <> '' GROUP BY 1, 2)
SELECT * FROM (SELECT nwo, split_a, split_b, a.n AS samples_a, b.n AS samples_b,
  row_number() OVER (PARTITION BY split_a, split_b ORDER BY a.n + b.n DESC, nwo)::INTEGER AS rank
  FROM {PAIRS} JOIN c a ON a.split = split_a JOIN c b USING (nwo) WHERE b.split = split_b) WHERE rank <= 10""",
    "docstring_exact_overlap": f"""WITH {FN}, n AS (SELECT split, {norm('docstring')} AS d FROM functions), t AS (
  SELECT count(*) FILTER (d IN (SELECT d FROM n WHERE split = 'train')) AS overlap, count(*) AS test_rows
  FROM n WHERE split = 'test' AND d <> '')
SELECT *, round(coalesce(overlap * 100.0::DOUBLE / nullif(test_rows, 0), 0), 6) AS pct FROM t""",
    "docstring_fuzzy": f"WITH {DOCSTRINGS} SELECT * FROM fuzzy",
    "docstring_fuzzy_summary": f"""WITH {DOCSTRINGS}, x AS (
  SELECT (SELECT count(*) FROM fuzzy) AS matched_07, (SELECT count(*) FROM fuzzy WHERE similarity >= 0.9) AS matched_09,
         (SELECT count(*) FROM t WHERE split = 'test') AS unique_test)
SELECT *, round(coalesce(matched_07 * 100.0::DOUBLE / nullif(unique_test, 0), 0), 6) AS pct_07,
  round(coalesce(matched_09 * 100.0::DOUBLE / nullif(unique_test, 0), 0), 6) AS pct_09 FROM x""",
    "top_fuzzy": f"""WITH {DOCSTRINGS} SELECT left(test_docstring, 80) AS test_docstring, left(train_docstring, 80) AS train_docstring, similarity
FROM fuzzy ORDER BY similarity DESC, fuzzy.test_docstring LIMIT 5""",
    "near_dup_pairs": f"""WITH {LSH} SELECT threshold, test_id, train_id, n_test AS test_rows, n_train AS train_rows, similarity
FROM lsh WHERE similarity >= threshold""",
    "near_dup_best": f"""WITH {LSH}
SELECT test_id, train_id, n_test AS test_rows, n_train AS train_rows, similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY similarity DESC, train_id) AS rn
  FROM lsh WHERE threshold = 0.7 AND similarity >= threshold
) WHERE rn = 1""",
    "near_dup_summary": f"""WITH {LSH}, per_test AS (
  SELECT threshold, test_key, any_value(n_test) AS n_test,
         sum(n_test * n_train) FILTER (similarity >= threshold) AS row_pairs FROM lsh GROUP BY 1, 2
), s AS (
  SELECT threshold, sum(n_test) AS candidate_rows, sum(n_test) FILTER (row_pairs IS NOT NULL) AS verified_rows,
         sum(row_pairs) AS verified_pairs FROM per_test GROUP BY 1
), z AS (
  SELECT v.threshold, coalesce(candidate_rows, 0)::BIGINT AS candidate_rows, coalesce(verified_rows, 0)::BIGINT AS verified_rows,
         coalesce(verified_pairs, 0)::BIGINT AS verified_pairs, (SELECT count(*) FROM functions WHERE split = 'test') AS test_rows
  FROM (VALUES {_BANDINGS}) v(threshold, n_bands, n_rows) LEFT JOIN s USING (threshold))
SELECT *, round(coalesce(candidate_rows * 100.0::DOUBLE / nullif(test_rows, 0), 0), 6) AS pct FROM z""",
    "top_near_dups": f"""WITH {LSH} SELECT test_id, train_id, similarity FROM lsh
WHERE threshold = 0.5 AND similarity >= 0.5 ORDER BY similarity DESC, test_id, train_id LIMIT 10""",
    "near_dup_sure": f"""WITH {SURE} SELECT test_id, train_id, test_rows, train_rows, similarity
FROM sim JOIN met USING (test_k, train_k) WHERE threshold = 0.7 AND similarity >= 0.7""",
    "near_dup_recall": f"""WITH {SURE} SELECT threshold, count(test_id) AS exact_pairs, count(test_id) FILTER (met.test_k IS NOT NULL) AS found_pairs,
  round(coalesce(count(test_id) FILTER (met.test_k IS NOT NULL)::DOUBLE / nullif(count(test_id), 0), 1.0), 6) AS recall
FROM (VALUES {_SURE}) v(threshold, n_bands, n_rows) LEFT JOIN sim ON similarity >= threshold LEFT JOIN met USING (threshold, test_k, train_k)
GROUP BY threshold""",
    "docstring_best": f"""WITH {DOCSTRINGS}, best AS (
  SELECT * FROM sims WHERE similarity > 0
  QUALIFY row_number() OVER (PARTITION BY test_docstring ORDER BY similarity DESC, train_docstring) = 1
)
SELECT t.docstring AS test_docstring, train_docstring, coalesce(similarity, 0)::DOUBLE AS similarity
FROM (SELECT DISTINCT docstring FROM d WHERE split = 'test' AND docstring <> '') t LEFT JOIN best ON test_docstring = t.docstring""",
    "near_dup_exact": f"""WITH {CONTENTS}, sets AS (
  SELECT array_to_string(list_sort(sh), '|') AS k, any_value(sh) AS sh, min(test_id) AS test_id, min(train_id) AS train_id,
         sum(n_test)::BIGINT AS n_test, sum(n_train)::BIGINT AS n_train FROM shingled GROUP BY 1
), sim AS (
  SELECT a.test_id, b.train_id, a.n_test AS test_rows, b.n_train AS train_rows, {jaccard('a.sh', 'b.sh')} AS similarity
  FROM sets a, sets b WHERE a.n_test > 0 AND b.n_train > 0
    AND least(len(a.sh), len(b.sh)) >= 0.69 * greatest(len(a.sh), len(b.sh)))
SELECT * FROM sim WHERE similarity >= 0.7""",
    "dataset_stats": f"""WITH {MEASURED} SELECT count(*) AS records, round(avg(function_lines), 6) AS mean_function_lines,
  round(avg(function_len), 6) AS mean_function_len, round(avg(docstring_len), 6) AS mean_docstring_len FROM lengths""",
    "source_counts": f"WITH {FN} SELECT source, count(*) AS n FROM functions WHERE source IS NOT NULL GROUP BY 1",
    "source_share": f"WITH {FN} {_share('source', 'functions')}",
    "identifier_share": f"WITH {FN}, x AS (SELECT CASE WHEN identifier <> '' THEN 'Yes' ELSE 'No' END AS has_identifier FROM functions) {_share('has_identifier', 'x')}",
    "length_columns": f"WITH {MEASURED} SELECT id, function_lines, docstring_len, function_len, ast_len, has_identifier FROM lengths",
    "length_histogram": f"""WITH {MEASURED}, b AS (SELECT measure, min(value) AS lo, max(value) AS hi FROM measures GROUP BY 1), x AS (
  SELECT measure, lo, hi, least(((value - lo) * 200) // greatest(hi - lo, 1), 199) AS bin FROM measures JOIN b USING (measure))
SELECT measure, bin::BIGINT AS bin, round(lo + bin * (hi - lo)::DOUBLE / 200, 6) AS bin_start, count(*) AS n FROM x GROUP BY measure, bin, lo, hi""",
    "length_density": f"""WITH {MEASURED}, b AS (
  SELECT measure, min(value) AS lo, max(value) AS hi, count(*) AS total, stddev_samp(value) * pow(count(*), -0.2) AS h FROM measures GROUP BY 1
), v AS (SELECT measure, value, count(*) AS n FROM measures GROUP BY 1, 2
), g AS (SELECT *, lo + i * (hi - lo)::DOUBLE / 199 AS x FROM b, range(200) r(i) WHERE h > 0)
SELECT measure, i::BIGINT AS point, round(x, 6) AS x,
  round(sum(n * exp(-0.5 * pow((x - value) / h, 2))) / (total * h * sqrt(2 * pi())), 10) AS density
FROM g JOIN v USING (measure) GROUP BY measure, i, x, total, h""",
    "top_repos": f"WITH {FN} SELECT nwo, count(*) AS n FROM functions WHERE nwo IS NOT NULL GROUP BY 1 ORDER BY n DESC, nwo LIMIT 10",
    **{
        name: "SELECT 'src/' || lang || '/' || doc_id || '.ets' AS path, md5(text) AS content_md5 FROM documents"
        for name in ("read_source_parquet", "read_source_json", "read_source_jsonl")
    },
    "read_tolerant_jsonl": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "read_repo_csv": "SELECT page_id, url, 'a \"b\", ' || url AS description FROM pages",
    "run_outcomes": """SELECT CASE WHEN doc_id % 7 > 0 AND n_chars > 500 THEN 'success' ELSE 'failure' END AS outcome, count(*) AS n
FROM documents GROUP BY 1""",
    "supported_languages": """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'ArkTS' ELSE 'arkts' END AS language FROM documents WHERE doc_id % 3 < 2""",
    "resumed_rows": f"WITH {FN} SELECT nwo, id, strlen(function)::BIGINT AS n_bytes FROM functions",
    "docstring_tokens": f"""WITH d AS (SELECT doc_id, regexp_extract_all({summary('text')}, {_DOC_TOKEN}) AS t FROM documents)
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens FROM d""",
    "word_tokens": f"SELECT doc_id, array_to_string({words('text')}, ' ') AS tokens FROM documents",
    "flatten_tokens": f"SELECT doc_id, array_to_string({words('text')}, ' ') AS tokens FROM documents",
    "shingles": f"""WITH d AS (SELECT doc_id, {words('text')} AS t FROM documents), s AS (SELECT doc_id, {shingles('t')} AS sh FROM d)
SELECT doc_id, len(sh) AS n, array_to_string(list_sort(sh), '|') AS shingles FROM s""",
    "normalize_text": f"SELECT doc_id, {norm('text')} AS normalized FROM documents",
    "token_jaccard": f"""WITH {FN}, t AS (SELECT id, list_distinct({words('docstring')}) AS a, list_distinct({words('function')}) AS b FROM functions)
SELECT id, round({jaccard('a', 'b')}, 9) AS jaccard FROM t""",
    "pair_key": f"WITH {FN} SELECT id, md5({norm('docstring')} || '|||' || {norm('function')}) AS pair_key FROM functions",
    "minhash_signature": f"""WITH {_PERM}, d AS (SELECT doc_id, {words('text')} AS t FROM documents), s AS (
  SELECT doc_id, unnest({shingles('t')}) AS s FROM d), h AS (SELECT doc_id, {_HASH} AS h FROM s), m AS (
  SELECT doc_id, i, min((a * h + b) % {PRIME}) AS m FROM h, perm GROUP BY 1, 2)
SELECT doc_id, string_agg(m, ',' ORDER BY i) AS signature FROM m GROUP BY 1""",
    "strip_comment": f"""WITH c AS (SELECT doc_id, '/** ' || replace(text, {NL}, {NL} || '  * ') || ' */' AS comment FROM documents)
SELECT doc_id, {strip_comment('comment')} AS stripped FROM c""",
    "docstring_summary": f"""WITH c AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, {NL}, {NL} || {NL})
  WHEN 1 THEN replace(text, '. ', ' @') ELSE text END AS docstring FROM documents)
SELECT doc_id, {summary('docstring')} AS summary FROM c""",
    "license_comment": """WITH c AS (SELECT doc_id, lower(text || CASE WHEN doc_id % 2 = 0 THEN ' Copyright' ELSE '' END) AS t FROM documents)
SELECT doc_id, contains(t, 'copyright') AND contains(t, 'license') AS is_license FROM c""",
    "code_tokens": f"""WITH {FILES}, t AS (SELECT file_id,
  list_filter(regexp_extract_all(content, {_CODE}), lambda x: NOT regexp_matches(x, '^{_WS}')) AS t FROM files)
SELECT file_id, len(t) AS n, array_to_string(t, ' ') AS tokens FROM t""",
    "extract_comments": f"""SELECT doc_id AS file_id, CASE WHEN doc_id % 3 < 2 THEN 1 ELSE 0 END + {_LINES} + 3 AS n,
  CASE doc_id % 3 WHEN 0 THEN '// Copyright holders of ' || source || '. All under license terms.' || {NL}
    WHEN 1 THEN '// module ' || lang || {NL} ELSE '' END || {views._DOC} || {NL} || '// ' || replace(text, {NL}, {NL} || '// ')
    || {NL} || '// size of ' || source AS comments FROM documents""",
    "remove_comments": f"""WITH {FILES}, t AS (SELECT file_id,
  list_filter(regexp_extract_all(content, {_CODE}), lambda x: NOT (starts_with(x, '//') OR starts_with(x, '/*'))) AS t FROM files)
SELECT file_id, array_to_string(t, '') AS code FROM t""",
    "extract_functions": f"""WITH {FOUND} SELECT file_id, kind, identifier, parameters, function, start_row::BIGINT AS start_row,
  start_col::BIGINT AS start_col, end_row::BIGINT AS end_row, end_col::BIGINT AS end_col FROM placed""",
    "segmented_functions": f"""WITH {FOUND} SELECT file_id, kind, identifier, parameters, function, start_row::BIGINT AS start_row,
  start_col::BIGINT AS start_col, end_row::BIGINT AS end_row, end_col::BIGINT AS end_col FROM placed""",
    "literal_functions": f"""
  SELECT doc_id AS file_id, 'function' AS kind, 'classes' || doc_id AS identifier, '(s)' AS parameters, {_PART['classes']} AS function, 0::BIGINT AS start_row
  FROM documents
  UNION ALL SELECT doc_id, 'arrow', '', '(x)', {_PART['outer']}, 2 FROM documents
  UNION ALL SELECT doc_id, 'arrow', 'q', '', {_PART['inner']}, 2 + {_TEXT_LINES} FROM documents
  UNION ALL SELECT doc_id, 'function', 'hole', '()', {_PART['hole']}, 3 + {_TEXT_LINES} FROM documents
  UNION ALL SELECT doc_id, 'function', 'tick', '(s, n)', {_PART['tick']}, 4 + {_TEXT_LINES} FROM documents""",
    "literal_comments": f"""SELECT doc_id AS file_id, '// half ' || chr(96) || 'of it' || {NL} || '/* $' || '{{ */' AS comments,
  {_PART['classes']} || ' ' || {NL} || 'let k = n / 2 / (n - 1) ;' || {NL} || 'const outer = ' || {_PART['outer']} || {NL}
    || {_PART['hole']} || {NL} || {_PART['tick']} || {NL} AS code FROM documents""",
    "attach_docstring": f"WITH {FOUND} SELECT file_id, identifier, kind, docstring FROM placed",
    "obfuscate_tokens": _OBF,
    "function_rows": f"""WITH {ROWS} SELECT * EXCLUDE (file_id, kind, start_row, start_col, end_row, end_col, content_bytes)
FROM (SELECT * EXCLUDE (lang, source, url) REPLACE (lang || '/' || source AS nwo, 'src/mod' || file_id || '.ets' AS path),
  'https://github.com/' || lang || '/' || source || '/blob/' || sha || '/src/mod' || file_id || '.ets#L' || (start_row + 1) || '-L' || (end_row + 1) AS url
  FROM found_rows WHERE file_id % 7 <> 0)""",
    "bulk_rows": f"""WITH {ROWS} SELECT * EXCLUDE (file_id, kind, lang, source, content_bytes) REPLACE (
  start_row::BIGINT AS start_row, start_col::BIGINT AS start_col, end_row::BIGINT AS end_row, end_col::BIGINT AS end_col),
  kind AS type FROM found_rows WHERE content_bytes <= {2**20}""",
    "page_fields": """SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, coalesce(regexp_extract_all(html, '<a href="([^"]*)"', 1)[1], '') AS first_link,
  len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS links FROM pages""",
    "listing_items": """SELECT s_suppkey AS page_id, s_name || '/repo' || s_suppkey AS full_name,
  'https://gitee.com/' || replace(s_name, '#', '-') AS url, s_nationkey AS stars, 'a & b <' || s_suppkey || '>' AS description, 'TypeScript' AS language
FROM supplier UNION ALL SELECT s_suppkey, 'bare' || s_suppkey, 'https://gitee.com/bare', 0, '', '' FROM supplier""",
    "license_from_payload": """SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN c_mktsegment
  WHEN c_custkey % 6 IN (1, 3) THEN upper(c_mktsegment) END AS license FROM customer""",
    "repos_from_payload": """SELECT c_custkey, c_name AS full_name, c_nationkey AS stargazers_count, c_mktsegment AS language FROM customer
UNION ALL SELECT c_custkey, c_name || '-fork', 0, NULL FROM customer""",
}
