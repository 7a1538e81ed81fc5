"""Functions out of source files, as relational operators over structural events.

A file's text is cut at its structural marks: brackets of all three kinds, template holes, string
and regex literals and runs of comments. Running sums over a file's marks (``places``) give offsets,
lines and bracket depth, and pair brackets. What stands between one bracket and its partner is a scope. A scope's own text, with everything in
inner brackets shrunk to one character a pair, is its skeleton; in it a function header is flat
text however deeply its parameters or types nest. One pattern per skeleton finds the headers, and
a window carries their places back into the file.

One shuffle moves each file's text, by file id, and one the scopes in which something is found; the
windows that place finds and the join back to the text reuse that partitioning. Marks are neither
sorted nor shuffled. A file is the unit of work of one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.expr import count_newlines, let, staged
from ..functions.lexing import COMMENT, NAME, STRING, renamed, with_tokens
from .places import GAP, HEAD, NEXT, SHRUNK, header_scopes_of, scopes_of
from .segments import segments
from .project import (
    BLACKLISTED_NAMES,
    function_record,
    has_min_tokens,
    is_source_path,
    path_to_nwo,
    within_size,
)

# Byte limits of a source file for the two bulk input formats.
PARQUET_MAX_BYTES = 2**20
JSON_MAX_BYTES = 2**15

# The kinds of construct that count as functions.
KINDS = (
    "method build function decorated_function export decorated_export constructor "
    "function_expression arrow"
).split()

# The language of files that do not say.
DEFAULT_LANGUAGE = "arkts"

# Characters per piece of a file's text when functions are cut out of it; no pieces are made where
# bytes times finds are no more than that.
_CHUNK = 1024
_SHORT = 1 << 17

# The skeleton's characters.
_P, _K, _B, _S, _C, _H = (SHRUNK[k] for k in ("(", "[", "{", "string", "comment", "${"))
_GAP, _HEAD, _NEXT = GAP, HEAD, NEXT
_OPENING = ("(", "[", "{", "${")

# Patterns over skeletons. Blanks may hold comments anywhere.
_W = rf"[\s{_C}]"
# A header starts where a word does; looking nowhere else keeps long words and blobs linear.
_START = r"(?<![\p{L}\p{N}_$.#@])"
_GENERIC = rf"(?:<[^;{_B}]*?>{_W}*+)?"
_UNIT = (
    rf"(?:(?:keyof|typeof|readonly|unique|infer|asserts|new){_W}++)*+"
    rf"(?:{NAME}(?:\.{NAME})*+(?:[ \t]*+<[^;]*?>)?|[{_P}{_K}{_B}{_S}]|-?[0-9][\w.]*+)(?:[ \t]*+{_K})*+"
)
_TYPE = rf"(?:[|&]{_W}*+)?{_UNIT}(?:{_W}*+(?:[|&]|=>|\bis\b){_W}*+{_UNIT})*"
_OF_TYPE = rf"{_W}*+:{_W}*+{_TYPE}"
_DECORATORS = rf"(?:@{NAME}(?:\.{NAME})*+(?:{_W}*+{_P})?{_W}*+)*+"
_EXPORT = rf"(?:export{_W}++(?:default{_W}++)?)?"
_MODIFIERS = (
    rf"(?:(?:public|private|protected|static|async|override|abstract|readonly|declare|get|set){_W}++)*+"
)
_FUNCTION = rf"function\b{_W}*+\*?{_W}*+(?:{NAME})?"
_METHOD = rf"(?:\*{_W}*+)?(?:#?{NAME}|{_S}|{_K}|[0-9]++)\??"
_BEFORE_PARAMETERS = rf"{_MODIFIERS}(?:{_FUNCTION}|{_METHOD}){_W}*+{_GENERIC}"
_DECLARATION = (
    rf"{_DECORATORS}{_EXPORT}{_DECORATORS}{_BEFORE_PARAMETERS}{_P}(?:{_OF_TYPE})?{_W}*+{_B}"
)
_CLASS = rf"(?:abstract{_W}++)?(?:class|struct|interface|enum|namespace)\b"
_EXPORTED_CLASS = rf"{_DECORATORS}export{_W}++(?:default{_W}++)?{_DECORATORS}{_CLASS}[^;{_B}]*+{_B}"
_EXPORTED_VALUE = rf"export{_W}++(?:const|let|var){_W}++{NAME}(?:{_OF_TYPE})?"
# Types that may hold arrows are passed over: aliases, declared variables, and members where
# members have types.
_ALIAS = rf"\btype{_W}++{NAME}{_W}*+{_GENERIC}={_W}*+{_TYPE}"
_VARIABLE = rf"\b(?:const|let|var){_W}++{NAME}{_W}*+!?{_OF_TYPE}"
_MEMBER = rf"{_START}{NAME}{_W}*+[?!]?{_OF_TYPE}"
_ARROW = rf"(?:{_START}async\b{_W}*+)?(?:{_GENERIC}{_P}(?:{_OF_TYPE})?|{_START}{NAME}){_W}*+=>"
# Up to a comma, semicolon or line end, unless the next line goes on or this one asks for more.
_EXPRESSION = rf"(?:[^;,\n]++|\n(?={_W}*+(?:[.?:*/%+]|&&|\|\||=>))|(?<=[=>&|+*/%?:-])\n)*+"
_BODY = rf"{_W}*+(?:{_B}|{_EXPRESSION})"


# What any of the headers below begins with, and that no word goes on there: most places of a
# skeleton are seen to hold none before the headers are tried one by one.
_MAY_START = rf"(?=[@*#<\p{{L}}\p{{N}}_${_P}{_K}{_S}])(?!(?<=[\p{{L}}\p{{Nd}}_])[\p{{L}}\p{{Nd}}_])"


def _pattern(members_have_types: bool) -> str:
    """Gap and header from where the last match ended; without that anchor a skeleton's tail would
    be searched again from each of its characters."""
    passed = "|".join([_ALIAS, _VARIABLE] + [_MEMBER] * members_have_types)
    return (
        rf"(?s)\G(.*?){_MAY_START}(?:((?<![\p{{L}}\p{{N}}_$.#])(?:{_EXPORTED_CLASS}|{_DECLARATION}))"
        rf"|({_START}{_EXPORTED_VALUE})(?=({_W}*+(?:={_W}*+{_EXPRESSION})?))"
        rf"|({passed})|({_ARROW})(?=({_BODY})))"
    )


_BINDING = (
    rf"\s*(?:(?:export\s+)?(?:const|let|var)\s+{NAME}\s*(?::[^=]*)?=\s*|(?:{NAME}|{_S})\s*:\s*"
    rf"|(?:(?:public|private|protected|static|readonly)\s+)*{NAME}\s*=\s*)?"
)

# Words that look like a method name in front of a parenthesis and a brace.
_CONTROL = ("if", "for", "while", "switch", "catch", "with", "return", "function", "super", "new")

_SCOPE = ("file_id", "inside", "scope")
# Offsets are summed in blocks of so many finds.
_BLOCK = 256


def scopes(texts: DataFrame, with_headers: bool = False) -> DataFrame:
    """One row per scope: the bracket that opened it and as what, whether a type, an arrow or a block
    stands behind its end (a parenthesis then holds parameters), and its items: the marks whose text
    it holds, with their places and their bracket's partner. ``with_headers`` leaves out scopes that
    can't hold a header, and items without a text."""
    found = (header_scopes_of if with_headers else scopes_of)("content")
    role = (
        F.when(F.col("before").rlike(rf"\b(?:interface\b[^;]*|type\s+{NAME}\s*(?:<[^;]*>)?\s*=\s*)\z"), "types")
        .when(F.col("before").rlike(r"\b(?:class|struct)\b[^;]*\z"), "members")
    )
    return staged(texts.select("file_id", F.inline(found)), opened_as=role).drop("before")


def _found_in(scopes: DataFrame) -> DataFrame:
    """Scopes with their items, role and opener, and the finds in their skeletons: of each, the gap
    before it with its offset, its header and its body."""
    typed = (F.col("opener") == "(") & F.coalesce("then_typed", F.lit(False))
    scopes = staged(
        scopes,
        role=F.coalesce(F.when(F.col("opener") == "{", F.col("opened_as")).when(typed, "members"), F.lit("code")),
        skeleton=F.array_join("items.text", ""),
    ).drop("opened_as", "then_typed")

    def marked(members_have_types: bool) -> Column:
        parts = f"$1$5{_GAP}$2$3$6{_HEAD}$4$7{_NEXT}"
        return F.regexp_replace("skeleton", F.lit(_pattern(members_have_types)), F.lit(parts))

    parts = F.split(F.when(F.col("role") == "code", marked(False)).otherwise(marked(True)), _NEXT, -1)
    scopes = staged(scopes, parts=F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))))
    scopes = scopes.drop("skeleton").where(F.size("parts") > 0)
    # Each part takes up its gap and header; the body behind stays to be searched.
    scopes = staged(scopes, lengths=F.transform("parts", lambda p: (F.instr(p, F.lit(_HEAD)) - F.lit(2)).cast("int")))

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("lengths") - 1) / _BLOCK).cast("int")),
        lambda b: total(F.slice("lengths", b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    scopes = staged(scopes, blocks=blocks)
    scopes = staged(
        scopes,
        firsts=F.transform(F.sequence(F.lit(0), F.size("blocks") - 1), lambda b: total(F.slice("blocks", F.lit(1), b))),
    ).drop("blocks")

    def find(p: Column, k: Column) -> Column:
        block = F.floor(k / _BLOCK).cast("int")
        offset = F.get("firsts", block) + total(F.slice("lengths", block * _BLOCK + 1, k % _BLOCK))
        behind = F.substring_index(p, _GAP, -1)
        return F.struct(
            k.alias("find"), offset.alias("offset"), F.substring_index(p, _GAP, 1).alias("gap"),
            F.substring_index(behind, _HEAD, 1).alias("header"),
            F.regexp_replace(F.substring_index(behind, _HEAD, -1), rf"{_W}++\z", "").alias("body"),
        )

    finds = F.filter(F.transform("parts", find), lambda f: f["header"] != "")
    return staged(scopes, finds=finds).drop("parts", "lengths", "firsts").where(F.size("finds") > 0)


def _located(scopes: DataFrame) -> DataFrame:
    """One row per find, with its places in the file."""
    nothing = {"text": "string", "start": "bigint", "row": "bigint", "line_start": "bigint", "end": "bigint",
               "end_row": "bigint", "close_end": "bigint", "close_row": "bigint", "kind": "string"}
    asked = {"find": "int", "what": "string", "gap": "string", "header": "string", "body": "string"}

    def entry(at: Column, values: dict[str, Column]) -> Column:
        fields = [values[n].cast(t).alias(n) if n in values else F.lit(None).cast(t).alias(n) for n, t in (nothing | asked).items()]
        return F.struct(at.cast("int").alias("at"), *fields)

    there = F.transform("items", lambda i: entry(i["at"], {n: i[n] for n in nothing}))

    def places(f: Column) -> Column:
        head_at = f["offset"] + F.length(f["gap"])
        before_parameters = F.length(F.regexp_extract(f["header"], rf"\A({_DECORATORS}{_EXPORT}{_DECORATORS}{_BEFORE_PARAMETERS}){_P}", 1))
        arrow_parameters = F.length(F.regexp_extract(f["header"], rf"\A((?:async\b{_W}*+)?{_GENERIC}){_P}", 1))
        is_arrow = f["header"].endswith("=>")
        has = F.contains(f["header"], F.lit(_P))
        comment = F.length(F.regexp_extract(f["gap"], rf"(?s)\A(.*){_C}{_BINDING}\z", 1))
        commented = f["gap"].rlike(rf"{_C}{_BINDING}\z")
        last = head_at + F.length(f["header"]) + F.length(f["body"]) - 1
        of = {"find": f["find"]}
        return F.array(
            entry(head_at, of | {"what": F.lit("head"), "gap": f["gap"], "header": f["header"], "body": f["body"]}),
            entry(last, of | {"what": F.lit("last")}),
            entry(F.when(has, head_at + F.when(is_arrow, arrow_parameters).otherwise(before_parameters)), of | {"what": F.lit("parameters")}),
            entry(F.when(commented, f["offset"] + comment), of | {"what": F.lit("comments")}),
        )

    wanted = F.filter(F.flatten(F.transform("finds", places)), lambda e: e["at"].isNotNull())
    rows = scopes.select(*_SCOPE, "role", "opener", F.inline(F.concat(there, wanted)))
    order = Window.partitionBy(*_SCOPE).orderBy("at", F.col("what").isNotNull())
    item = F.when(F.col("what").isNull(), F.struct("at", *nothing))
    rows = rows.withColumn("i", F.last(item, ignorenulls=True).over(order)).where("what IS NOT NULL")
    within = F.col("at") - F.col("i.at")
    lead_text = F.substr(F.col("i.text"), F.lit(1), within)
    newlines = count_newlines(lead_text)
    start = F.col("i.start") + within
    on_mark = within == F.length("i.text") - 1
    group = on_mark & F.col("i.kind").isin(*_OPENING)
    literal = on_mark & F.col("i.kind").isin("string", "comment")
    rows = rows.select(
        *_SCOPE, "role", "opener", "find", "what", "gap", "header", "body",
        start.alias("start"),
        (F.col("i.row") + newlines).alias("row"),
        F.when(newlines > 0, F.length(F.substring_index(lead_text, "\n", -1)))
        .otherwise(start - F.col("i.line_start")).cast("bigint").alias("col"),
        F.when(group, F.col("i.close_end")).when(literal, F.col("i.end")).otherwise(start + 1).alias("stop"),
        F.when(group, F.col("i.close_row")).when(literal, F.col("i.end_row"))
        .otherwise(F.col("i.row") + count_newlines(F.substr(F.col("i.text"), F.lit(1), within + 1))).alias("stop_row"),
    )

    def of(what: str, column: str) -> Column:
        return F.max(F.when(F.col("what") == what, F.col(column)))

    return rows.groupBy(*_SCOPE, "find").agg(
        *[of("head", c).alias(c) for c in ("role", "opener", "gap", "header", "body", "start")],
        of("head", "row").alias("start_row"), of("head", "col").alias("start_col"),
        of("last", "stop").alias("stop"), of("last", "stop_row").alias("end_row"),
        of("parameters", "start").alias("parameters_start"), of("parameters", "stop").alias("parameters_stop"),
        of("comments", "start").alias("comments_start"), of("comments", "stop").alias("comments_stop"),
    ).where("stop IS NOT NULL")


def _declared(found: DataFrame) -> DataFrame:
    """Finds that are functions or exports, with kind, identifier and flags."""
    rows = staged(
        found,
        is_arrow=F.col("header").endswith("=>"),
        core=F.regexp_replace("header", rf"\A{_DECORATORS}{_EXPORT}{_DECORATORS}", ""),
        exported=F.col("header").rlike(rf"\A{_DECORATORS}export\b"),
        decorated=F.col("header").startswith("@") | F.col("header").rlike(rf"\Aexport{_W}++(?:default{_W}++)?@"),
        starts_statement=F.col("gap").rlike(rf"(?:\A|[\n,;{_B}{_C}])[^\S\n]*+\z"),
        behind_operator=F.col("gap").rlike(r"(?:[=(,:?&|\[!+]|\breturn|\bnew|\bdefault)\s*\z"),
    )
    is_class = F.col("core").rlike(rf"\A{_CLASS}[^{_P}{_B}]*+{_B}\z") & F.col("exported")
    is_value = F.col("core").rlike(r"\A(?:const|let|var)\b") & F.col("exported") & ~F.col("is_arrow")
    name = (
        F.when(F.col("is_arrow"), F.regexp_extract("core", rf"\A(?:async\b\s*)?({NAME}){_W}*+=>\z", 1))
        .when(is_class, F.regexp_extract("core", rf"\A{_CLASS}{_W}*+({NAME})", 1))
        .when(is_value, F.regexp_extract("core", rf"\A(?:const|let|var){_W}++({NAME})", 1))
        .otherwise(F.regexp_extract("core", rf"\A{_MODIFIERS}(?:function\b{_W}*+\*?{_W}*+|\*{_W}*+)?(#?{NAME}|{_S}|{_K}|[0-9]++)?", 1))
    )
    rows = staged(
        rows,
        identifier=name,
        is_other=is_class | is_value,
        is_function=F.col("core").rlike(rf"\A{_MODIFIERS}function\b") & ~F.col("is_arrow"),
        no_parameters=F.col("parameters_stop") - F.col("parameters_start"),
    )
    inner = F.col("opener").isin("(", "[", "${") & (text.strip("gap") == "")
    in_expression = (F.col("identifier") == "") | F.col("behind_operator") | F.coalesce(inner, F.lit(False))
    kind = (
        F.when(F.col("is_arrow"), "arrow")
        .when((F.col("is_other") | F.col("is_function")) & F.col("exported") & F.col("decorated"), "decorated_export")
        .when((F.col("is_other") | F.col("is_function")) & F.col("exported"), "export")
        .when(F.col("is_function") & in_expression, "function_expression")
        .when(F.col("is_function") & F.col("decorated"), "decorated_function")
        .when(F.col("is_function"), "function")
        .when(F.col("identifier") == "constructor", "constructor")
        .when((F.col("identifier") == "build") & (F.col("no_parameters") == 2), "build")
        .otherwise("method")
    )
    # In code, a capitalised call with a trailing block is a UI component; in a class, a method.
    component = F.col("core").rlike(rf"\A\p{{Lu}}[\p{{L}}\p{{N}}_$]*\s*{_P}\s*{_B}\z") & ~F.col("decorated") & (F.col("role") != "members")
    method = F.col("starts_statement") & ~F.col("identifier").isin(*_CONTROL) & ~component & (
        F.coalesce(F.col("opener"), F.lit("{")) == "{"
    )
    # An arrow behind a member's colon with nothing but a plain type for a body is a type as well.
    plain_type = F.col("body").rlike(
        rf"\A{_W}*+(?:void|string|number|boolean|any|never|unknown|object|undefined|null)\b(?:{_K})*{_W}*+\z"
    ) & F.col("gap").rlike(rf"{NAME}\??\s*:\s*\z")
    type_arrow = F.col("is_arrow") & ((F.col("role") == "types") | plain_type)
    rows = staged(rows, kind=kind, is_method=method, type_arrow=type_arrow)
    return rows.where(
        ~F.col("type_arrow") & (~F.col("kind").isin("method", "build", "constructor") | F.col("is_method"))
    )


def _found(texts: DataFrame) -> DataFrame:
    # Marks are placed by file in Arrow batches, which Spark does not see: their scopes are dealt by
    # file once more, only those with finds.
    return _declared(_located(_found_in(scopes(texts, with_headers=True)).repartition("file_id")))


def cut_out(texts: DataFrame, found: DataFrame, spans: dict[str, tuple[str, str]]) -> DataFrame:
    """``found`` with the text of each span, named by its start and stop columns.

    Cutting each span out of the whole text would walk the text once per span; cut out of short
    chunks it costs the span's own length. A file's finds meet its text in one row.
    """
    fields = [c for c in found.columns if c != "file_id"]
    finds = found.groupBy("file_id").agg(F.collect_list(F.struct(*fields)).alias("finds"))
    # What few finds ask of a short text is counted off from its start; what is no UTF-8 is first read
    # by the pattern, as everywhere.
    short = (F.octet_length("content").cast("bigint") * F.size("finds") <= _SHORT) & F.is_valid_utf8("content")
    chunks = F.when(short, F.array("content")).otherwise(F.regexp_extract_all("content", F.lit(rf"(?s).{{1,{_CHUNK}}}"), F.lit(0)))
    step = F.when(short, F.lit(2**31 - 1)).otherwise(F.lit(_CHUNK))

    def between(chunk: Column, start: Column, stop: Column) -> Column:
        first, last = (F.floor(at / step).cast("int") for at in (start, stop - 1))
        several = F.array_join(F.transform(F.sequence(first, last), lambda i: F.get(chunk, i)), "")
        around = F.when(first == last, F.get(chunk, first)).otherwise(several)
        return F.when(start.isNotNull(), F.substr(around, (start % step).cast("int") + 1, (stop - start).cast("int")))

    def with_texts(chunk: Column, find: Column) -> Column:
        cut = [between(chunk, find[a], find[b]).alias(name) for name, (a, b) in spans.items()]
        return F.struct(*[find[c].alias(c) for c in fields], *cut)

    cuts = let(chunks, lambda chunk: F.transform("finds", lambda find: with_texts(chunk, find)))
    # Merged in place: texts made by a query can be far larger than the planner's estimate from the
    # files, which would send all of them through the driver.
    # inline_outer: a plain one is given a filter on the array's size, which would cut twice.
    return texts.hint("merge").join(finds.hint("merge"), "file_id").select("file_id", F.inline_outer(cuts))


def docstring_of(comments: Column) -> Column:
    """Docstring out of the run of comments in front of a function.

    The last comment always counts. Further up, comments are taken until a blank line parts two
    of them (the gap before the last one is not looked at), leaving out licence comments.
    """
    pieces = F.regexp_extract_all(comments, F.lit(rf"\s*+(?:{COMMENT})"), F.lit(0))

    def clean(piece: Column) -> Column:
        return text.strip_comment(F.regexp_replace(piece, r"\A\s+", ""))

    def build(p: Column) -> Column:
        n = F.size(p)
        parted = F.transform(
            F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
            lambda i: F.when(F.get(p, i - 1).rlike(r"\A\s*?\n\s*?\n"), i).otherwise(F.lit(1)),
        )
        taken = F.slice(p, F.array_max(parted), F.greatest(n, F.lit(0)))
        upper = F.filter(F.slice(taken, F.lit(1), F.greatest(F.size(taken) - 1, F.lit(0))), lambda c: ~text.is_license_comment(c))
        return F.array_join(F.transform(F.concat(upper, F.slice(p, -1, 1)), clean), " ")

    return F.when(comments.isNotNull(), let(pieces, build)).otherwise(F.lit(""))


def _written_name(function: str) -> Column:
    """A name that is a string or computed is shrunk in the skeleton; it is the first in the text."""
    written = F.regexp_extract(function, rf"\A[^\"'`\[(]*+({STRING}|\[[^\]]*+\])", 1)
    return F.when(F.col("identifier").isin(_S, _K), written).otherwise(F.col("identifier"))


def with_docstrings(files: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Functions as ``extract_functions`` finds them, with kind, identifier and docstring only: what
    is in front of a function is cut out of the text, not the function."""
    texts = files.where(within_size("content", max_bytes)).select("file_id", "content").repartition("file_id")
    shrunk = F.when(F.col("identifier").isin(_S, _K), F.col("start"))
    found = _found(texts).select(
        "file_id", "kind", "identifier", shrunk.alias("named_start"), "stop", "comments_start", "comments_stop"
    )
    cut = cut_out(texts, found, {"named": ("named_start", "stop"), "comments": ("comments_start", "comments_stop")})
    cut = cut.select(
        "file_id", "kind", _written_name("named").alias("identifier"), docstring_of(F.col("comments")).alias("docstring")
    )
    others = files.drop("content")
    return others.join(cut, "file_id") if others.columns != ["file_id"] else cut


def extract_functions(files: DataFrame, max_bytes: int | None = None, split_above: int | None = None) -> DataFrame:
    """Functions of source files: one row per function, nested ones included.

    With ``split_above``, files of more characters are cut into segments between top-level
    declarations, each the work of one task; otherwise a file is.
    ``files`` has a unique ``file_id``, ``content`` and any further columns, which are kept.
    Adds kind, identifier, parameters, exported, docstring, function, start/end row and column.
    Files over ``max_bytes`` give no rows; without it there is no limit.
    """
    texts = files.where(within_size("content", max_bytes)).select("file_id", "content")
    if split_above is not None:
        cut = segments(texts, split_above)
        texts = cut.select(F.struct("file_id", "segment", "first_row").alias("file_id"), "content")
    # Both sides of the join below start from this one exchange and stay partitioned by file_id.
    texts = texts.repartition("file_id")
    found = _found(texts).select(
        "file_id", "kind", "identifier", "exported", "start", "stop", "start_row", "start_col", "end_row",
        "parameters_start", "parameters_stop", "comments_start", "comments_stop",
    )
    spans = {"function": ("start", "stop"), "parameters": ("parameters_start", "parameters_stop"), "comments": ("comments_start", "comments_stop")}
    cut = cut_out(texts, found, spans)
    last_line = F.substring_index("function", "\n", -1)
    end_col = F.length(last_line) + F.when(F.col("start_row") == F.col("end_row"), F.col("start_col")).otherwise(F.lit(0))
    cut = cut.withColumns({
        "end_col": end_col.cast("bigint"),
        "docstring": docstring_of(F.col("comments")),
        "parameters": F.coalesce("parameters", F.lit("")),
        "identifier": _written_name("function"),
    }).select(
        "file_id", "kind", "identifier", "parameters", "exported", "start_row", "start_col", "end_row", "end_col",
        "function", "docstring",
    )
    if split_above is not None:
        first = F.col("file_id.first_row")
        cut = cut.withColumns({"start_row": F.col("start_row") + first, "end_row": F.col("end_row") + first, "file_id": F.col("file_id.file_id")})
    others = files.drop("content")
    return others.join(cut, "file_id") if others.columns != ["file_id"] else cut


def with_text_forms(functions: DataFrame) -> DataFrame:
    """Add docstring_summary, code tokens and the obfuscated forms."""
    return with_tokens(functions).withColumns({
        "docstring_summary": text.docstring_summary("docstring"),
        "obf_function": F.array_join(renamed(F.col("_parts"), keep_space=True), ""),
        "obf_function_tokens": renamed(F.col("_parts"), keep_space=False),
    }).drop("_parts")


def is_kept(identifier: str = "identifier", tokens: str = "function_tokens") -> Column:
    return ~F.col(identifier).isin(*BLACKLISTED_NAMES) & has_min_tokens(tokens)


def with_language(files: DataFrame, language: str = DEFAULT_LANGUAGE) -> DataFrame:
    """``language`` as the language of files that have no column of that name."""
    return files if "language" in files.columns else files.withColumn("language", F.lit(language))


def kept_rows(extracted: DataFrame) -> DataFrame:
    """Extracted functions with their text forms, without inherited names and one-token ones."""
    return with_text_forms(extracted).where(is_kept())


def kept_functions(files: DataFrame, max_bytes: int | None = None, language: str = DEFAULT_LANGUAGE) -> DataFrame:
    return kept_rows(extract_functions(with_language(files, language), max_bytes))


def function_rows(files: DataFrame, max_bytes: int | None = None, language: str = DEFAULT_LANGUAGE) -> DataFrame:
    """The whole extraction job over a files table: 22-column rows ready for deduplication."""
    return function_record(kept_functions(files, max_bytes, language))


def bulk_rows(files: DataFrame, max_bytes: int | None = None, language: str = DEFAULT_LANGUAGE) -> DataFrame:
    """Function rows with the construct's type and its place: the 22 columns, type, start_point and
    end_point as structs of row and column, counted from zero."""
    return placed_rows(kept_functions(files, max_bytes, language))


def placed_rows(kept: DataFrame) -> DataFrame:
    place = F.struct("type", "start_point", "end_point")
    found = kept.withColumns({
        "type": F.col("kind"),
        "start_point": F.struct(F.col("start_row").cast("int").alias("row"), F.col("start_col").cast("int").alias("col")),
        "end_point": F.struct(F.col("end_row").cast("int").alias("row"), F.col("end_col").cast("int").alias("col")),
    })
    return function_record(found.withColumn("_place", place), "_place").select("*", "_place.*").drop("_place")


def repository_rows(files: DataFrame, max_bytes: int | None = None, language: str = DEFAULT_LANGUAGE) -> DataFrame:
    """Function rows of checked-out repositories.

    ``files`` has path, content and sha; owner and relative path come from the path, test and
    dependency files are left out. One job over all repositories, partitioned by file.
    """
    return function_rows(repository_files(files), max_bytes, language)


def repository_files(files: DataFrame) -> DataFrame:
    """Source files of repositories with their owner and relative path, their whole path as id."""
    nwo, inner = path_to_nwo("path")
    files = files.withColumns({"file_id": F.col("path"), "nwo": nwo, "path": inner})
    return files.where(is_source_path("path"))


def _files_with_finds(texts: DataFrame) -> DataFrame:
    """Ids of files in which something is found, without locating it."""
    found = _found_in(scopes(texts, with_headers=True))
    unclosed = F.transform(
        F.filter("items", lambda i: i["kind"].isin(*_OPENING) & i["close_end"].isNull()),
        lambda i: (i["at"] + F.length(i["text"]) - 1).cast("int"),
    )
    rows = found.select("file_id", "role", "opener", unclosed.alias("unclosed"), F.inline("finds"))
    last = F.col("offset") + F.length("gap") + F.length("header") + F.length("body") - 1
    nowhere = F.lit(None).cast("bigint")
    ends = rows.where(~F.array_contains("unclosed", last.cast("int")))
    return _declared(ends.withColumns({"parameters_start": nowhere, "parameters_stop": nowhere})).select("file_id").distinct()


def file_status(files: DataFrame, max_bytes: int | None = None, found: DataFrame | None = None) -> DataFrame:
    """(file_id, status) of each file: ok, undecodable for null content, too_large, or unmatched
    when nothing was found in it. ``found`` may bring functions already extracted, by file_id."""
    fits = within_size("content", max_bytes)
    if found is None:
        found = _files_with_finds(files.where(fits).select("file_id", "content"))
    found = found.select("file_id").distinct().withColumn("found", F.lit(True))
    flagged = files.select("file_id", F.col("content").isNull().alias("undecodable"), fits.alias("fits"))
    status = (
        F.when(F.col("undecodable"), "undecodable")
        .when(~F.col("fits"), "too_large")
        .when(F.col("found"), "ok")
        .otherwise("unmatched")
    )
    return flagged.join(found, "file_id", "left").select("file_id", status.alias("status"))


def extract_status(files: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """(status, files) over all files."""
    return file_status(files, max_bytes).groupBy("status").agg(F.count("*").alias("files"))
