"""Source files of any size, cut where a top-level declaration ends.

Whether a place in a file is code, comment or template, and how deep, depends on all before it. A
large file is therefore cut into chunks at line ends, each read by a task of its own without knowing
what precedes it: for every mode it may begin in, and behind every ``}`` whose partner is not in the
chunk, it says which brackets stay unmatched and in which mode the chunk ends. These summaries are
functions from state to state; composing them in order gives each chunk the state it begins in. With
that a second pass finds the lines at which a top-level block is over and a declaration begins.
What lies between two of these is a segment: it reads as a file by itself, so extraction takes
segments where it took files, and one top-level construct, not one file, is the work of one task.
"""

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import count_newlines
from ..functions.modes import Modes

# Characters of a chunk, without the rest of its last line.
CHUNK = 1 << 20
# Segments are at least this part of a chunk long, where a chunk doesn't end.
LEAST = 1 / 16

_DECLARATION = re.compile(
    r"\s*+(?:(?:/\*(?:[^*]|\*(?!/))*+\*/|//[^\n]*+\n)\s*+)*+"
    r"(?:@|(?:export|function|class|struct|interface|enum|namespace|abstract|declare|import|const|let|var)\b)"
)
_MODES = ("code", "comment", "template")


def summary(chunk: str) -> dict[str, list]:
    """What a chunk does to the state before it: by "place mode", the closing brackets without a
    partner, then either where the next ``}`` without one was passed, or the brackets left open and
    the mode at the end."""
    nodes, todo = {}, [(0, m) for m in _MODES]
    while todo:
        at, mode = node = todo.pop()
        if f"{at} {mode}" in nodes:
            continue
        modes = Modes(mode, inner=True)
        for _ in modes.scan(chunk, at):
            pass
        if modes.stopped >= 0:
            todo += [(modes.stopped, m) for m in ("code", "template")]
            rest = [modes.stopped]
        else:
            rest = [[list(e) for e in modes.stack], modes.mode]
        nodes["%d %s" % node] = [modes.closed, *rest]
    return nodes


def composed(state: tuple[str, list], nodes: dict[str, list]) -> tuple[str, list]:
    """The state (mode, open brackets) behind a chunk, from the one before it."""
    mode, stack = state[0], list(state[1])
    at = 0
    while True:
        closed, *rest = nodes[f"{at} {mode}"]
        for bracket in closed:
            if stack and stack[-1][0] == {")": "(", "]": "["}[bracket]:
                stack.pop()
        if len(rest) == 2:
            return rest[1], stack + rest[0]
        while stack and stack[-1][0] not in ("{", "${"):
            stack.pop()
        mode = "template" if stack and stack.pop()[0] == "${" else "code"
        at = rest[0]


def boundaries(chunk: str, state: tuple[str, list], least: int) -> list[int]:
    """Line starts of a chunk at which a segment may begin, at least so many characters apart."""
    modes, found = Modes(state[0], [tuple(e) for e in state[1]]), []
    for _, _, end, kind in modes.scan(chunk):
        if kind == "}" and not modes.stack and end - (found[-1] if found else 0) >= least:
            line = re.compile(r"[ \t;]*+\r?\n").match(chunk, end)
            if line and _DECLARATION.match(chunk, line.end()):
                found.append(line.end())
    return found


@F.arrow_udf(T.ArrayType(T.StringType()))
def _entries(summaries: pa.Array) -> pa.Array:
    """The state each chunk of a file begins in, from its chunks' summaries in order; no text."""
    out = []
    for nodes in summaries.to_pylist():
        state, states = ("code", []), []
        for n in nodes:
            states.append(json.dumps(state))
            state = composed(state, json.loads(n))
        out.append(states)
    return pa.array(out, pa.list_(pa.string()))


@F.arrow_udf(T.StringType())
def _summaries(chunks: pa.Array) -> pa.Array:
    return pa.array([json.dumps(summary(c)) for c in chunks.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def _parts(chunks: pa.Array, states: pa.Array, least: pa.Array) -> pa.Array:
    """Each chunk cut at its boundaries; the first part belongs to the segment before."""
    out = []
    for chunk, state, n in zip(chunks.to_pylist(), states.to_pylist(), least.to_pylist()):
        at = boundaries(chunk, json.loads(state), n)
        out.append([chunk[a:b] for a, b in zip([0, *at], [*at, len(chunk)])])
    return pa.array(out, pa.list_(pa.string()))


def segments(files: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(file_id, segment, first_row, content): files of more than ``chunk`` characters in segments,
    the others whole, null content left out. A file's segments, joined in order, are its content.

    The largest unit that one task holds is a chunk, a file's summaries, or a segment.
    """
    files = files.select("file_id", "content").where("content IS NOT NULL")
    long = F.length("content") > chunk
    whole = files.where(~long).select("file_id", F.lit(0).cast("bigint").alias("segment"), F.lit(0).cast("bigint").alias("first_row"), "content")
    lines = rf"(?s).{{0,{chunk}}}(?:(?:[^\n\\]|\\.)*+\n|[^\n]*+\z)"
    cut = files.where(long).select("file_id", F.posexplode(F.regexp_extract_all("content", F.lit(lines), F.lit(0))).alias("chunk", "text"))
    chunks = cut.where("text <> ''").repartition("file_id", "chunk")
    thin = chunks.select("file_id", "chunk", _summaries("text").alias("nodes"))
    listed = thin.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "nodes"))).alias("nodes"))
    states = F.arrays_zip(F.col("nodes.chunk").alias("chunk"), _entries("nodes.nodes").alias("state"))
    entries = listed.select("file_id", F.inline(states))
    parts = chunks.join(entries, ["file_id", "chunk"]).select("file_id", "chunk", _parts("text", "state", F.lit(int(chunk * LEAST))).alias("parts"))
    # What follows is read from this exchange twice: chunks are cut once, and both sides need the text.
    parts = parts.repartition("file_id", "chunk")
    # Thin again: how many segments and rows a file's chunks before have.
    sizes = parts.select(
        "file_id", "chunk", (F.size("parts") - 1).alias("more"), count_newlines(F.array_join("parts", "")).alias("rows")
    )
    before = Window.partitionBy("file_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "file_id", "chunk",
        F.coalesce(F.sum("more").over(before), F.lit(0)).alias("segments_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )
    # posexplode_outer: a plain one is given a filter on the array's size, which would cut again, and
    # the exchange would be another one. No chunk is without parts.
    placed = parts.join(sizes, ["file_id", "chunk"]).select(
        "file_id", "chunk", "segments_before", "rows_before", "parts", F.posexplode_outer("parts").alias("part", "text")
    )
    # A chunk has few parts, by LEAST.
    inside = count_newlines(F.array_join(F.slice("parts", F.lit(1), F.col("part")), ""))
    placed = placed.select(
        "file_id", "chunk", "part", "text",
        (F.col("segments_before") + F.col("part")).alias("segment"), (F.col("rows_before") + inside).alias("row"),
    )
    joined = placed.groupBy("file_id", "segment").agg(
        F.min("row").alias("first_row"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part", "text"))), lambda p: p["text"]), "").alias("content"),
    )
    return whole.unionByName(joined.select("file_id", "segment", "first_row", "content"))
