"""Lexical patterns for TypeScript-family source code and functions over the tokens.

Patterns alone can't tell a regex literal from division, nor find the end of a template whose holes
hold templates. Texts without a slash that isn't a comment's and without template holes need
neither: they are cut by patterns in the JVM. The others pass their literals' places through
``modes``, in Arrow batches, and only what stands between is cut by patterns.

Possessive quantifiers matter: Java evaluates a possessive group in a loop, where a greedy one
recurses once per repetition and overflows the task's stack on long literals.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expr import as_col, let, staged
from .modes import whole_literals

NAME = r"[\p{L}_$][\p{L}\p{N}_$]*+"
COMMENT = r"/\*(?:[^*]++|\*(?!/))*+(?:\*/)?|//[^\n]*+"
STRING = r"""(?:"(?:[^"\\\n]++|\\[\s\S])*+"?|'(?:[^'\\\n]++|\\[\s\S])*+'?|`(?:[^`\\]++|\\[\s\S])*+`?)"""
NUMBER = r"[0-9][0-9A-Za-z_.]*+"
OPERATOR = (
    r"=>|\.\.\.|===|!==|\*\*|\+\+|--|&&|\|\||\?\?|\?\.|==|!=|<=|>=|[-+*/%&|^]=|[\s\S]"
)
TOKEN = rf"(?:{COMMENT})|{STRING}|{NAME}|{NUMBER}|\s++|{OPERATOR}"

# Words that are never obfuscated (keywords and primitive types).
RESERVED = (
    "abstract any as async await bigint boolean break case catch class const constructor "
    "continue debugger declare default delete do else enum export extends false finally for "
    "from function get if implements import in instanceof interface keyof let namespace never "
    "new null number object of override private protected public readonly return set static "
    "string struct super switch symbol this throw true try type typeof undefined unknown var "
    "void while with yield"
).split()


# A slash that begins or ends no comment.
_LONE_SLASH = r"(?<![/*])/(?![/*])"


def has_plain_literals(c) -> Column:
    """Whether patterns find all literals: no regex literal, division or template hole."""
    c = as_col(c)
    return ~(c.rlike(_LONE_SLASH) | (F.contains(c, F.lit("`")) & F.contains(c, F.lit("${"))))


def _lists(texts: pa.Array, of_text, names: list[str]) -> pa.Array:
    """One list of structs for each text, null for null; ``of_text`` gives a text's rows."""
    offsets, rows = [0], []
    for text in texts.to_pylist():
        if text is not None:
            rows.extend(of_text(text))
        offsets.append(len(rows))
    columns = list(zip(*rows)) or [()] * len(names)
    types = [pa.bool_() if n == "literal" else pa.string() for n in names]
    structs = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs, mask=texts.is_null())


def _cut_at_literals(text: str) -> list[tuple[str, bool]]:
    out, at = [], 0
    for start, end in whole_literals(text):
        out += [(text[at:start], False), (text[start:end], True)]
        at = end
    return [(t, literal) for t, literal in [*out, (text[at:], False)] if t]


def _rows_of(**fields: T.DataType) -> T.DataType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


@F.arrow_udf(_rows_of(text=T.StringType(), literal=T.BooleanType()))
def _at_literals(texts: pa.Array) -> pa.Array:
    return _lists(texts, _cut_at_literals, ["text", "literal"])


def lex(c, known_plain: Column | None = None) -> Column:
    """All tokens including whitespace and comments; joined they give the text back. ``known_plain``
    may say that patterns find all literals, without another look at the text."""
    c = as_col(c)
    plain = has_plain_literals(c) if known_plain is None else known_plain | has_plain_literals(c)

    def cut(text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))

    parts = _at_literals(F.when(~plain, c))
    odd = F.flatten(F.transform(parts, lambda p: F.when(p["literal"], F.array(p["text"])).otherwise(cut(p["text"]))))
    return F.when(plain, cut(c)).otherwise(odd)


def is_comment(tok: Column) -> Column:
    return tok.startswith("//") | tok.startswith("/*")


def _is_code(tok: Column) -> Column:
    return ~(is_blank(tok) | is_comment(tok))


def is_blank(tok: Column) -> Column:
    return tok.rlike(r"\A\s")


def code_tokens(c, comments: bool = True) -> Column:
    """Leaf tokens without whitespace, string literals whole."""
    if comments:
        return F.filter(lex(c), lambda t: ~is_blank(t))
    return F.filter(lex(c), _is_code)


def comments_of(c) -> Column:
    return F.filter(lex(c), is_comment)


def remove_comments(c) -> Column:
    return F.array_join(F.filter(lex(c), lambda t: ~is_comment(t)), "")


def _renamed(parts: Column, keep_space: bool) -> Column:
    """Tokens of the lexed parts (head, params, type, body), comments dropped and names replaced."""

    def kept(part: str) -> Column:
        return F.filter(parts[part], (lambda t: ~is_comment(t)) if keep_space else _is_code)

    def names(toks: Column, typed: bool) -> Column:
        stops = [".", "?."] + ([":"] if typed else [])

        def name_or_null(t: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(toks, i - 1))
            if keep_space:
                before = F.when((i > 1) & is_blank(F.coalesce(before, F.lit(""))), F.get(toks, i - 2)).otherwise(before)
            free = ~F.coalesce(before, F.lit("")).isin(stops)
            return F.when(t.rlike(rf"\A{NAME}\z") & ~t.isin(RESERVED) & free, t)

        return F.transform(toks, name_or_null)

    def rename(toks: Column, found: Column, order: Column) -> Column:
        return F.zip_with(
            toks,
            found,
            lambda t, n: F.when(n.isNull(), t).otherwise(
                F.concat(F.lit("arg_"), (F.array_position(order, n) - 1).cast("string"))
            ),
        )

    code = F.struct(*[kept(p).alias(p) for p in ("params", "type", "body")])
    return F.concat(
        kept("head"),
        let(code, lambda p: let(
            F.struct(names(p["params"], True).alias("params"), names(p["body"], False).alias("body")),
            lambda n: let(
                F.array_distinct(F.array_compact(F.concat(n["params"], n["body"]))),
                lambda order: F.concat(
                    rename(p["params"], n["params"], order),
                    p["type"],
                    rename(p["body"], n["body"], order),
                ),
            ),
        )),
    )


def renamed(parts: Column, keep_space: bool = False) -> Column:
    """``obfuscated`` of the ``_parts`` that ``with_tokens`` adds."""
    return let(parts, lambda p: _renamed(p, keep_space))


def obfuscated(function, parameters, keep_space: bool = False) -> Column:
    """Tokens with parameter and body identifiers renamed arg_0, arg_1, … by first appearance.

    The text before the parameter list and the return type stay as they are. So do members after
    a dot, parameter types and reserved words. Comments are dropped.
    """
    function, parameters = as_col(function), as_col(parameters)
    at = F.when(parameters == "", F.lit(1)).otherwise(F.greatest(F.instr(function, parameters), F.lit(1)))
    rest = F.substr(function, at + F.length(parameters))
    parts = {"head": F.substr(function, F.lit(1), at - 1), "params": parameters} | _behind(rest, _body_at(rest, parameters))
    return renamed(F.struct(*[lex(c).alias(n) for n, c in parts.items()]), keep_space)


def _body_at(rest: Column, parameters: Column) -> Column:
    # Without a parameter list (a bare arrow) everything is body.
    return F.when(parameters == "", F.lit(1)).otherwise(F.greatest(F.instr(rest, F.lit("{")), F.lit(1)))


def _behind(rest: Column, body_at: Column) -> dict[str, Column]:
    return {"type": F.substr(rest, F.lit(1), body_at - 1), "body": F.substr(rest, body_at)}


def _last_is_code(tokens: Column) -> Column:
    last = F.coalesce(F.get(tokens, F.size(tokens) - 1), F.lit(""))
    # A backslash may have lost what it escapes, and with it the literal that it stands in.
    return ~(is_comment(last) | last.rlike(r"""\A["'`\\]"""))


def with_tokens(df: DataFrame, function: str = "function", parameters: str = "parameters") -> DataFrame:
    """Add function_tokens (code tokens) and _parts, the tokens of the text before the parameter list,
    of the list, of the return type and of the body, from one reading of each text.

    Tokens of the whole text are those of its parts wherever no token runs across a border. Borders
    stand at brackets, so only an open literal or comment can; there the whole text is read as well.
    """
    function, parameters = as_col(function), as_col(parameters)
    df = staged(
        df,
        _plain=F.coalesce(has_plain_literals(function), F.lit(False)),
        _found=F.when(parameters == "", F.lit(1)).otherwise(F.instr(function, parameters)),
    )
    at = F.greatest("_found", F.lit(1))
    df = staged(
        df,
        # Cut at brackets, a plain text's parts are plain.
        _whole=F.coalesce(
            F.col("_plain") & (F.col("_found") > 0) & ((parameters == "") | (parameters.startswith("(") & parameters.endswith(")"))),
            F.lit(False),
        ),
        _head=F.substr(function, F.lit(1), at - 1),
        _rest=F.substr(function, at + F.length(parameters)),
    )
    df = staged(df, _body_at=_body_at(F.col("_rest"), parameters))
    cut = {"head": F.col("_head"), "params": parameters} | _behind(F.col("_rest"), F.col("_body_at"))
    df = staged(df, _cut=F.struct(*[c.alias(n) for n, c in cut.items()])).drop("_plain", "_found", "_head", "_rest", "_body_at")
    df = staged(df, _parts=F.struct(*[lex(F.col("_cut")[n], F.col("_whole")).alias(n) for n in cut])).drop("_cut")
    seamless = F.col("_whole")
    for n in ("head", "params", "type"):
        seamless = seamless & _last_is_code(F.col("_parts")[n])
    df = staged(df, _seamless=F.coalesce(seamless, F.lit(False))).drop("_whole")
    whole = F.when(F.col("_seamless"), F.concat(*[F.col("_parts")[n] for n in cut])).otherwise(lex(F.when(~F.col("_seamless"), function), F.col("_seamless")))
    return staged(df, function_tokens=F.filter(whole, lambda t: ~is_blank(t))).drop("_seamless")
