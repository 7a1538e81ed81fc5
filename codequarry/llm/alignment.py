"""Alignment of two tokenizers over the same texts, Arrow-native.

A task takes texts in blocks of bounded bytes. The ids of a block are one list array a tokenizer:
flattening gives the token rows, parent indices their documents, and a segmented cumulative sum of
token bytes their ends. An Acero full outer join of both sides on (document, end) then holds the
whole alignment in end order: a row found on both sides closes a group, and since every stretch of
text between two neighbouring ends lies in exactly one token of each side, filling missing ids
backward makes each row one link. ``Table.group_by`` counts a block's links per document and the
documents per id pair; Spark sums the partial counts, marks the best pairs of each A id, and sends
counts and marks back to the blocks that asked for them.

What is shuffled is one row per id pair and block (not per document, so a pair that every document
has is one row a block), and a block's links with pairs as positions, compressed. The blocks are
written to the shared folder, so no text is encoded twice.

Defined results: a null or empty text, and one that either tokenizer does not spell back byte for
byte, has no tokens: zeros and an empty digest. Rows may repeat, and each counts as a document; ids
may be null; an empty table gives an empty result; other columns are left out, whatever their
names. A text longer than a block is a block of its own.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written
from . import encoders
from .common import blocks_of, texts

# Bytes of text in a block; a task holds one at a time, with about 60 bytes an input byte.
BLOCK_BYTES = 4 << 20

_DOCS = "array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,n_pairs:int>>"
_BLOCKS = f"block bigint, docs {_DOCS}, pairs array<struct<a:int,b:int,docs:bigint>>, used binary, times binary"
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint,"
    " groups_sha256 string"
)
_CODEC = "zstd"


def _packed(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.astype("<u4").tobytes(), codec=_CODEC, asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, 4 * n, codec=_CODEC, asbytes=True), "<u4").astype(np.int64)


def _token_lists(whole: list[str], encoder) -> pa.ListArray:
    packed = [encoder.ids(t) if t else b"" for t in whole]
    offsets = np.cumsum([0, *map(len, packed)]) // encoders.WIDTH
    ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))


def _spells(lists: pa.ListArray, spelled: pa.Array, wanted: list[bytes]) -> list[bool]:
    """Whether each list's tokens, joined, are the bytes wanted."""
    joined = pc.take(spelled, lists.flatten())
    lengths = pc.binary_length(joined).to_numpy(zero_copy_only=False)
    data = memoryview(joined.buffers()[2] if len(joined) else b"").cast("B")
    ends = np.concatenate([[0], np.cumsum(lengths)])[lists.offsets.to_numpy()].tolist()
    return [data[a:b] == w for a, b, w in zip(ends, ends[1:], wanted)]


def _tokens(lists: pa.ListArray, lengths: pa.Array, name: str) -> pa.Table:
    """One row per token: document, end in the document's bytes, id."""
    ids, docs = lists.flatten(), pc.list_parent_indices(lists).cast(pa.int32())
    running = pc.cumulative_sum(pc.take(lengths, ids))
    starts = lists.offsets.to_numpy()[:-1]
    before = np.concatenate([[0], running.to_numpy()])[starts]
    ends = pc.subtract(running, pc.take(pa.array(before, pa.int64()), docs))
    return pa.table({"doc": docs, "end": ends, name: ids})


def _joined(strings: pa.Array, counts: np.ndarray, separator: str) -> pa.Array:
    """Neighbouring strings joined, so many at a time as ``counts`` says."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, strings), pa.scalar(separator, strings.type))


def aligned(whole: list[str], a, b, spelled_a: pa.Array, spelled_b: pa.Array) -> tuple[dict, pa.Table]:
    """Counts and group digests of each text, and its links as (doc, end, a, b) in order."""
    wanted = [b" " + t.encode() if t else b"" for t in whole]
    lists_a = _token_lists([" " + t if t else "" for t in whole], a)
    lists_b = _token_lists(whole, b)
    good = np.array(_spells(lists_a, spelled_a, wanted), bool) & np.array(_spells(lists_b, spelled_b, wanted), bool)
    if not good.all():
        fine = pa.array(good)
        lists_a, lists_b = (pc.if_else(fine, x, pa.scalar([], x.type)) for x in (lists_a, lists_b))
    length_a, length_b = (pc.binary_length(s).cast(pa.int64()) for s in (spelled_a, spelled_b))
    ends = _tokens(lists_a, length_a, "a").join(
        _tokens(lists_b, length_b, "b"), ["doc", "end"], join_type="full outer", use_threads=False
    )
    ends = ends.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()
    doc = ends["doc"].to_numpy()
    in_a, in_b = (pc.is_valid(ends[c]).to_numpy() for c in "ab")
    closes = in_a & in_b
    n = len(whole)
    group = np.cumsum(closes) - closes
    n_all = int(closes.sum())
    strings = [
        _joined(pc.drop_null(ends[c]).combine_chunks().cast(pa.large_string()), np.bincount(group[there], minlength=n_all), ",")
        for c, there in (("a", in_a), ("b", in_b))
    ]
    groups = pc.binary_join_element_wise(*strings, pa.scalar("|", pa.large_string()))
    n_groups = np.bincount(doc[closes], minlength=n)
    per_doc = _joined(groups, n_groups, ";").to_pylist()
    counts = {
        "n_a": np.bincount(doc[in_a], minlength=n),
        "n_b": np.bincount(doc[in_b], minlength=n),
        "n_groups": n_groups,
        "n_links": np.bincount(doc, minlength=n),
        "groups_sha256": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in per_doc],
    }
    links = pa.table({"doc": ends["doc"], "end": ends["end"], "a": pc.fill_null_backward(ends["a"]), "b": pc.fill_null_backward(ends["b"])})
    return counts, links


def _block_row(block: int, ids: pa.Array, counts: dict, links: pa.Table) -> pa.RecordBatch:
    used = links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
    pairs = used.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
    key = lambda t: (t["a"].to_numpy().astype(np.int64) << 32) | t["b"].to_numpy()
    known = key(pairs)
    order = np.argsort(known)
    at = np.searchsorted(known[order], key(used))
    by_doc = np.lexsort((at, used["doc"].to_numpy()))
    n_pairs = np.bincount(used["doc"].to_numpy(), minlength=len(ids))
    docs = pa.StructArray.from_arrays(
        [ids.cast(pa.int64()), *[pa.array(v) for v in counts.values()], pa.array(n_pairs, pa.int32())],
        ["doc_id", *counts, "n_pairs"],
    )
    distinct = pa.StructArray.from_arrays(
        [pairs[c].combine_chunks().take(pa.array(order)) for c in ("a", "b", "count_all")], ["a", "b", "docs"]
    )
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int64()), one(docs), one(distinct),
            pa.array([_packed(at[by_doc])], pa.binary()),
            pa.array([_packed(used["count_all"].to_numpy()[by_doc])], pa.binary()),
        ],
        ["block", "docs", "pairs", "used", "times"],
    )


def blocks(docs: DataFrame, a_json: bytes, b_model: bytes, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of texts: its documents, its distinct id pairs with the number of its
    documents that hold them linked, and each document's pairs (as places in that list) and how
    often it holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = encoders.from_json(a_json, plain_special=True), encoders.SegmentEncoder(b_model)
        spelled_a = pa.array(encoders.spelled_by_json(a_json), pa.large_binary())
        spelled_b = pa.array(b.spelled(), pa.large_binary())
        first = TaskContext.get().partitionId() << 32
        for k, table in enumerate(blocks_of(batches, block_bytes)):
            counts, links = aligned(table["text"].to_pylist(), a, b, spelled_a, spelled_b)
            yield _block_row(first + k, table["doc_id"].combine_chunks(), counts, links)

    return texts(docs).mapInArrow(run, _BLOCKS)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, count, best) out of partial counts (a, b, docs): documents that hold a pair linked,
    and whether no other pair of the same A id has more."""
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    # An A id has as many pairs as B has ids, at most.
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


def _finished(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    docs = pa.chunked_array([c.flatten() for c in left["docs"].chunks]).combine_chunks()
    columns = dict(zip([f.name for f in docs.type], docs.flatten()))
    at = right["pair"].to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    count[at], best[at] = right["count"].to_numpy(), right["best"].to_numpy()
    n_pairs = columns.pop("n_pairs").to_numpy()
    n = int(n_pairs.sum())
    used, times = (_unpacked(left[c][0].as_py(), n) for c in ("used", "times"))
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[used], times * count[used])]
    ends = np.concatenate([[0], np.cumsum(n_pairs)])
    columns["n_best"], columns["count_sum"] = (pa.array(np.diff(s[ends])) for s in sums)
    return pa.table({c.split()[0]: columns[c.split()[0]] for c in RESULT.split(", ")})


def alignment(docs: DataFrame, a_json: bytes, b_model: bytes, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_json`` is a byte-level tokenizers file, ``b_model`` a sentencepiece model.
    """
    made = written(blocks(docs, a_json, b_model, block_bytes), "aligned")
    pairs = made.select("block", F.posexplode("pairs").alias("pair", "p")).select("block", "pair", "p.*")
    marks = pairs.join(pair_counts(pairs), ["a", "b"]).select(F.col("block").alias("of"), "pair", "count", "best")
    heavy = made.select("block", "docs", "used", "times")
    return heavy.groupBy("block").cogroup(marks.groupBy("of")).applyInArrow(_finished, RESULT)
