"""Where the marks of files stand, over Arrow batches of whole files.

Patterns cut a text at its marks, or the mode stack where they can't tell. Running sums over a
file's marks give their offsets, lines and bracket depth; brackets of one level that follow each
other are partners; marks of one depth between two closing brackets share a scope. All but the
cutting is sums and one sort over the batch's marks as numpy columns, with no loop over files.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.modes import CLOSING, OPENING, marks_of

# Skeleton characters: a pair of brackets of each kind with all it holds, a string, comments, and a
# template hole.
SHRUNK = {"(": "\ue000", "[": "\ue001", "{": "\ue002", "string": "\ue003", "comment": "\ue004", "${": "\ue005"}
# What ends the gap before a find, its header, and its body.
GAP, HEAD, NEXT = "\ue010", "\ue011", "\ue012"
_PRIVATE = "".join([*SHRUNK.values(), GAP, HEAD, NEXT])
# What ``text.strip`` takes away.
_BLANKS = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_ITEM = {
    "at": T.IntegerType(), "pos": T.IntegerType(), "text": T.StringType(), "start": T.LongType(), "row": T.LongType(),
    "line_start": T.LongType(), "end": T.LongType(), "end_row": T.LongType(), "close_end": T.LongType(), "close_row": T.LongType(),
    "kind": T.StringType(),
}
_SCOPE = {
    "inside": T.IntegerType(), "scope": T.IntegerType(), "opener": T.StringType(), "before": T.StringType(), "then_typed": T.BooleanType(),
}


def _list_of(**fields: T.DataType) -> T.DataType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


def _cast(columns: dict, types: dict[str, T.DataType]) -> dict[str, pa.Array]:
    return {n: (c if isinstance(c, pa.Array) else pa.array(c)).cast(to_arrow_type(types[n])) for n, c in columns.items()}


def _cut(contents: pa.Array) -> tuple[np.ndarray, dict]:
    """How many marks each file has, and of each mark the text before it, its kind, and length, line
    ends and characters behind the last line end of both together."""
    counts, noises, kinds, numbers = [], [], [], []
    # What is no UTF-8 reads as it does in the JVM's patterns.
    for content in contents.cast(pa.large_binary()).to_pylist():
        before = len(kinds)
        text = "" if content is None else content.decode("utf-8", "replace") + "\n"
        for begin, start, end, kind in marks_of(text):
            if end > begin:
                noises.append(text[begin:start])
                kinds.append("string" if kind == "template" else kind)
                lines = text.count("\n", begin, end)
                numbers += (end - begin, lines, end - 1 - text.rfind("\n", begin, end) if lines else end - begin)
        counts.append(len(kinds) - before)
    size, lines, tail = np.array(numbers, np.int64).reshape(-1, 3).T
    marks = {"noise": pa.array(noises, pa.string()), "kind": pa.array(kinds, pa.string()), "size": size, "lines": lines, "tail": tail}
    return np.array(counts, np.int64), marks


def _flags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _scopes(contents: pa.Array, with_headers: bool) -> pa.Array:
    counts, given = _cut(contents)
    size, lines, tail = given["size"], given["lines"], given["tail"]
    opens, closes = (
        _flags(pc.is_in(given["kind"], value_set=pa.array(k, pa.string()))).astype(np.int64) for k in (OPENING, CLOSING)
    )
    block = _flags(pc.equal(given["kind"], "{"))
    # In a skeleton the text before a mark is followed by what stands for the mark and all it opens.
    shrunk = pa.array([SHRUNK.get(k, "") for k in given["kind"].to_pylist()], pa.string())
    texts = pc.binary_join_element_wise(pc.replace_substring_regex(given["noise"], f"[{_PRIVATE}]", "_"), shrunk, "")
    typed = _flags(pc.match_substring_regex(given["noise"], r"\A[ \t\n\v\f\r]*(?::|=>)")) | (
        block & _flags(pc.match_substring_regex(given["noise"], rf"\A[{_BLANKS}]*\z"))
    )
    n = len(size)
    file = np.repeat(np.arange(len(counts)), counts)
    first = (np.cumsum(counts) - counts)[file]
    here = np.arange(n)

    def in_file(values: np.ndarray) -> np.ndarray:
        total = np.cumsum(values)
        return total - (total - values)[first]

    def neighbour(column: pa.Array, at: np.ndarray, there: np.ndarray) -> pa.Array:
        return column.take(pa.array(np.where(there, at, 0), mask=~there))

    end, end_row, depth = in_file(size), in_file(lines), in_file(opens - closes)
    # Where the line that a mark's text starts in begins: a file's line starts only grow, and none
    # is before the file.
    began = np.cumsum(size) - end
    line = np.maximum.accumulate(np.where(lines > 0, began + end - tail, began)) if n else began
    line_start = np.where(here > first, np.roll(line, 1), began) - began

    # The next bracket of an opening one's level closes it.
    brackets = np.flatnonzero(opens + closes)
    level = (depth - opens)[brackets]
    by_level = np.lexsort((level, file[brackets]))
    follow, level = brackets[by_level], level[by_level]
    partner = np.full(n, -1)
    same = (file[follow[1:]] == file[follow[:-1]]) & (level[1:] == level[:-1]) & (opens[follow[:-1]] > 0)
    partner[follow[:-1][same]] = follow[1:][same]

    # Every scope ends in the one closing bracket that carries its last text, and scopes of one depth
    # follow each other.
    inside = depth - opens + closes
    order = np.lexsort((inside, file))
    of_file, at_depth = file[order], inside[order]
    apart = np.ones(n, bool)
    apart[1:] = (of_file[1:] != of_file[:-1]) | (at_depth[1:] != at_depth[:-1])
    begins = apart.copy()
    begins[1:] |= closes[order[:-1]] > 0
    scope, begin = np.cumsum(begins) - 1, np.flatnonzero(begins)
    begin_of_depth = np.maximum.accumulate(np.where(apart, scope, 0)) if n else scope
    number = scope
    length = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)[order]
    before = np.cumsum(length) - length
    at = before - before[begin][scope]
    ends = np.append(begin[1:], n)[: len(begin)]

    kept, items = np.ones(len(begin), bool), np.arange(n)
    if with_headers:
        header = block | _flags(pc.or_(pc.match_substring(given["noise"], "=>"), pc.match_substring(given["noise"], "export")))
        kept = np.bincount(scope, header[order], len(begin)) > 0
        items = np.flatnonzero(kept[scope] & (length > 0))
    begin, ends, scope, at, marks = begin[kept], ends[kept], scope[items], at[items], order[items]

    closed = partner[marks] >= 0
    columns = _cast({
        "at": at,
        "pos": here[marks] - first[marks],
        "text": texts.take(pa.array(marks)),
        "start": (end - size)[marks], "row": (end_row - lines)[marks], "line_start": line_start[marks],
        "end": end[marks], "end_row": end_row[marks],
        "close_end": pa.array(end[partner[marks]], mask=~closed), "close_row": pa.array(end_row[partner[marks]], mask=~closed),
        "kind": given["kind"].take(pa.array(marks)),
    }, _ITEM)
    rows = pa.StructArray.from_arrays(list(columns.values()), list(columns))
    head, last = order[begin], order[ends - 1]
    opened = head > first[head]
    scopes = _cast({
        "inside": inside[head], "scope": (number - begin_of_depth)[begin],
        "opener": neighbour(given["kind"], head - 1, opened),
        "before": neighbour(given["noise"], head - 1, opened & block[head - 1]),
        "then_typed": neighbour(pa.array(typed), last + 1, last + 1 < (first + counts[file])[last]),
    }, _SCOPE)
    of_scope = np.bincount(scope, minlength=len(kept))[kept]
    scopes["items"] = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(of_scope)), pa.int32()), rows)
    found = pa.StructArray.from_arrays(list(scopes.values()), list(scopes))
    per_file = np.bincount(of_file[begin], minlength=len(counts))
    offsets = np.append(0, np.cumsum(per_file))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found, mask=contents.is_null())


_SCOPES = _list_of(**_SCOPE, items=_list_of(**_ITEM))


@F.arrow_udf(_SCOPES)
def scopes_of(contents: pa.Array) -> pa.Array:
    """The scopes of each file's text with all their items; null for null."""
    return _scopes(contents, with_headers=False)


@F.arrow_udf(_SCOPES)
def header_scopes_of(contents: pa.Array) -> pa.Array:
    """The scopes that can hold a header, with the items that have a text; most scopes are argument
    lists and conditions without a block, an arrow or an export."""
    return _scopes(contents, with_headers=True)
