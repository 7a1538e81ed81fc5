"""Calls and imports out of source files: what ``links`` joins to library definitions.

Both come from the structural marks that extraction uses. A call is a parenthesis with a name before
it that is neither a keyword nor a declaration's parameter list; its innermost enclosing function is
found by nesting: functions open and close in order, so the last one opened at a call's depth holds
it. An import statement is found at its string and cut out of the text. Names then tell where a call
leads: to an imported name, under its own or another name, to a function of the same file, or
elsewhere.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import count_newlines, staged
from ..functions.lexing import NAME, remove_comments
from .extract import _found, cut_out, scopes
from .places import SHRUNK

# Words before a parenthesis that are no call.
_NO_CALLS = (
    "if for while switch catch with function return typeof await in of case new throw delete void yield super import do else"
).split()
_GENERIC = r"(?:<[^;(){}]*>)?"
_CALLEE = rf"(?:(?<![\p{{L}}\p{{N}}_$])|(?<=\s))((?:(?:\?\.|\.)\s*)?(?:{NAME}\s*(?:\?\.|\.)\s*)*{NAME})\s*(?:\?\.)?\s*{_GENERIC}\s*\z"
_DECLARED = rf"\bfunction\b\s*\*?\s*{NAME}\s*{_GENERIC}\s*\z"
_DECORATOR = rf"@{NAME}(?:\.{NAME})*\s*\z"
# In a class body, calls stand in initialisers only.
_INITIALISER = rf"[=,(\[?:&|+!>]\s*(?:(?:await|new)\s+)*(?:{NAME}\s*(?:\?\.|\.)\s*)*{NAME}\s*{_GENERIC}\s*\z"
_STATEMENT = r"(?s)\A(.*)\b(?:import|export)\b"
_FROM = r"\bfrom\s*\z"
_BARE = r"\bimport\s*\z"


def _noise(text: Column, kind: Column) -> Column:
    """The text before a mark, out of its skeleton text."""
    return F.when(kind.isin(*SHRUNK), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def _marks(texts: DataFrame) -> DataFrame:
    rows = scopes(texts).select("file_id", "inside", F.col("opened_as").alias("role"), F.inline("items"))
    return staged(rows, noise=_noise(F.col("text"), F.col("kind")))


def _call_marks(marks: DataFrame) -> DataFrame:
    rows = staged(marks.where("kind = '(' AND close_end IS NOT NULL"), callee=F.regexp_extract("noise", _CALLEE, 1))
    name = F.regexp_extract("callee", rf"({NAME})\z", 1)
    rows = rows.withColumn("name", name).where(
        (F.col("name") != "") & ~F.col("name").isin(*_NO_CALLS) & ~F.col("noise").rlike(_DECLARED)
        & ~F.col("noise").rlike(_DECORATOR) & (F.coalesce("role", F.lit("")) != "types")
        & ((F.coalesce("role", F.lit("")) != "members") | F.col("noise").rlike(_INITIALISER))
    )
    # From the callee's start to the parenthesis.
    behind = F.regexp_extract("noise", _CALLEE, 0)
    return rows.select(
        "file_id", F.col("name").alias("identifier"),
        F.regexp_replace("callee", r"[\s?]", "").alias("callee"),
        (F.col("end") - 1).alias("arguments_start"), F.col("close_end").alias("arguments_stop"),
        (F.col("end_row") - count_newlines(F.regexp_replace(behind, r"\A\s+", ""))).alias("start_row"), F.col("close_row").alias("end_row"),
    )


def _within(calls: DataFrame, functions: DataFrame) -> DataFrame:
    """Calls with the innermost function around each, its name and where it starts."""
    nothing = F.lit(None)
    opening = functions.select(
        "file_id", F.col("start").alias("at"), F.lit(1).alias("step"), F.struct("identifier", "start_row").alias("caller"), nothing.alias("call")
    )
    closing = functions.select("file_id", F.col("stop").alias("at"), F.lit(-1).alias("step"), nothing.alias("caller"), nothing.alias("call"))
    fields = [c for c in calls.columns if c != "file_id"]
    asking = calls.select("file_id", F.col("arguments_start").alias("at"), F.lit(0).alias("step"), nothing.alias("caller"), F.struct(*fields).alias("call"))
    rows = opening.unionByName(closing).unionByName(asking)
    order = Window.partitionBy("file_id").orderBy("at", "step", F.desc("caller.start_row"))
    # Where functions begin at one place, the outer one was opened first; a call is asked before
    # what begins at its parenthesis.
    rows = rows.withColumn("depth", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    level = Window.partitionBy("file_id", "depth").orderBy("at", "step").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("caller", F.when(F.col("depth") > 0, F.last("caller", ignorenulls=True).over(level)))
    return rows.where("call IS NOT NULL").select("file_id", "call.*", F.coalesce("caller.identifier", F.lit("")).alias("caller"), F.col("caller.start_row").alias("caller_row"))


def source_calls(files: DataFrame) -> DataFrame:
    """Calls in source files: file_id, identifier (the last name), callee (the dotted name; with a
    leading dot behind another expression), argument_list, start_row, end_row, and the innermost
    function around it: caller ('' for none or one without a name) and caller_row."""
    texts = files.where("content IS NOT NULL").select("file_id", "content").repartition("file_id")
    calls, functions = _call_marks(_marks(texts)), _found(texts)
    parameters = functions.where("parameters_start IS NOT NULL").select("file_id", F.col("parameters_start").alias("arguments_start"))
    calls = calls.join(parameters.hint("merge"), ["file_id", "arguments_start"], "left_anti")
    cut = cut_out(texts, _within(calls, functions), {"argument_list": ("arguments_start", "arguments_stop")})
    return cut.select(
        "file_id", "identifier", "callee", "argument_list",
        *[F.col(c).cast("int").alias(c) for c in ("start_row", "end_row")], "caller", F.col("caller_row").cast("int").alias("caller_row"),
    )


def source_imports(files: DataFrame) -> DataFrame:
    """Imported names of source files: file_id, module, name and alias.

    ``name`` is the name in the module: 'default' for a default import, '*' for a whole module, ''
    where nothing is named; ``alias`` is the name in the file. Re-exports count as imports. So do
    ``require`` with a literal and dynamic imports, as whole modules without an alias.
    """
    texts = files.where("content IS NOT NULL").select("file_id", "content").repartition("file_id")
    marks = _marks(texts)
    begin = F.col("start")
    w = Window.partitionBy("file_id").orderBy("pos")
    marks = marks.withColumns({
        # The last import or export keyword so far, outside all brackets.
        "keyword": F.last(
            F.when((F.col("inside") == 0) & F.col("noise").rlike(_STATEMENT), begin + F.length(F.regexp_extract("noise", _STATEMENT, 1))), ignorenulls=True
        ).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "before": F.lag("noise").over(w),
        "opener": F.lag("kind").over(w),
    })
    literal = F.col("kind") == "string"
    statement = literal & (F.col("inside") == 0) & F.col("noise").rlike(rf"{_FROM}|{_BARE}") & F.col("keyword").isNotNull()
    called = literal & (F.col("opener") == "(") & (F.trim("noise") == "") & F.col("before").rlike(r"(?<![\p{L}\p{N}_$.])(?:require|import)\s*\z")
    found = marks.where(statement | called).select(
        "file_id", F.when(statement, F.col("keyword")).otherwise(F.col("start") + F.length("noise")).alias("start"), F.col("end").alias("stop"),
    )
    cut = cut_out(texts, found, {"text": ("start", "stop")}).where("text IS NOT NULL")
    cut = staged(cut, text=remove_comments("text"))
    module = F.regexp_extract("text", r"(?s)([\"'`])([^\"'`]*)\1\s*\z", 2)
    clause = F.regexp_extract("text", r"(?s)\A(?:import|export)\b(?:\s+type\b(?=\s*[{*\p{L}_$]))?(.*?)\bfrom\s*[\"']", 1)
    rows = staged(cut, module=module, clause=clause)
    braced = F.regexp_extract("clause", r"\{([^}]*)\}", 1)
    named = F.transform(
        F.filter(F.transform(F.split(braced, ","), lambda n: F.trim(n)), lambda n: n.rlike(NAME)),
        lambda n: F.struct(
            F.regexp_extract(n, rf"\A(?:type\s+)?({NAME})", 1).alias("name"), F.regexp_extract(n, rf"({NAME})\s*\z", 1).alias("alias")
        ),
    )
    star = F.regexp_extract("clause", rf"\*\s*(?:as\s+({NAME}))?", 1)
    default = F.regexp_extract("clause", rf"\A\s*({NAME})\s*(?:,|\z)", 1)

    def one(name: str, alias: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), alias.alias("alias"))

    names = F.concat(
        F.when(default != "", F.array(one("default", default))).otherwise(F.array().cast("array<struct<name:string,alias:string>>")),
        F.when(F.contains("clause", F.lit("*")), F.array(one("*", star))).otherwise(F.array().cast("array<struct<name:string,alias:string>>")),
        named,
    )
    whole = F.array(one("", F.lit("")))
    names = F.when(F.size(names) > 0, names).otherwise(whole)
    return rows.where("module <> ''").select("file_id", "module", F.inline(names))


def resolved_calls(calls: DataFrame, imports: DataFrame, functions: DataFrame) -> DataFrame:
    """``calls`` with where each leads: ``origin`` 'imported', 'local' or 'other', with ``module``
    and ``name`` (the name it has there) for imported ones.

    The first name of a callee decides. ``functions`` has file_id and identifier; a name that is
    both imported and defined in the file is imported.
    """
    aliases = imports.where("alias <> ''").groupBy("file_id", F.col("alias").alias("_first")).agg(F.min(F.struct("module", "name")).alias("_import"))
    defined = functions.select("file_id", F.col("identifier").alias("_first")).where("_first <> ''").distinct().withColumn("_defined", F.lit(True))
    first = F.substring_index("callee", ".", 1)
    rows = calls.withColumn("_first", F.when(first != "", first))
    # Merged: what comes out of texts grows with the files, whatever the planner takes their size for.
    rows = rows.join(aliases.hint("merge"), ["file_id", "_first"], "left").join(defined.hint("merge"), ["file_id", "_first"], "left")
    imported = F.col("_import").isNotNull()
    alone = F.col("callee") == F.col("_first")
    return rows.select(
        *calls.columns,
        F.when(imported, "imported").when(F.col("_defined") & alone, "local").otherwise("other").alias("origin"),
        F.col("_import.module").alias("module"),
        F.when(imported & alone & ~F.col("_import.name").isin("*", "default"), F.col("_import.name")).when(imported, F.col("identifier")).alias("name"),
    )
