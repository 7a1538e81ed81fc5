"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints that differ in at most three bits agree in one of any four groups of bits. That gives
the index its upper nodes: fingerprints are dealt out by (mask, pattern), a quarter of the bits and
what stands there, once for each quarter. A node with too many fingerprints is refined the same
way by a quarter of its remaining bits, ``LEVELS`` levels deep at most; a node that is still too
large goes whole to one task. No link is lost. Below, a task sorts a node's fingerprints by Gray rank (neighbours then
differ in few bits), factors the bits that runs of them share into a tree of masked patterns, and
joins the tree with itself from the top, adding up differences over the newly shared bits: a pair
of subtrees is dropped as soon as these exceed three, or when all it holds is connected already.

A task does not emit its pairs but the components they make, as edges to one member each; these
join into whole components in ``components``. Equal fingerprints count once from the start.

Defined results: null, empty and blank texts have no words and fingerprint zero, which links like
any other; rows may repeat; null ids never are a component's id unless it has no other; an empty
table gives an empty result; other columns never matter.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import per_batch, texts, whole_text
from .components import components

BITS = 64
DISTANCE = 3
SHINGLE = 3
SEED = 42
# Nodes with more fingerprints are refined, down to the last level; a node of the last level may have
# more, and a task compares as many squared at worst.
NODE = 2048
# Levels of masks at most. Four leave 20 or 21 bits open, so a node has at most 2**21 fingerprints.
LEVELS = 4
# Children of a tree node, and pairs of nodes looked at in one step: they have up to FANOUT squared
# times as many pairs of children, of some 64 bytes each while these are formed.
FANOUT = 8
FRONTIER = 1 << 14
# Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: str) -> int:
    """Majority bits of the hashes of all word shingles, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[min(SHINGLE, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, ends)), "<u8", len(ends))
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), BLOCK):
        part = h[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, fp): fp as a signed long; k1 and k2 tell rows with different texts apart."""
    rows = texts(docs).select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"),
        "text",
    )

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t) for t in part.column("text").to_pylist()]
        fp = pa.array(np.array(found, "<u8").view("<i8"))
        return pa.RecordBatch.from_arrays([*part.columns[:3], fp], names=["doc_id", "k1", "k2", "fp"])

    return per_batch(rows, batch, "doc_id long, k1 long, k2 long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a code in the Gray sequence, as a signed long in the same order."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def finer_masks(mask: int) -> list[int]:
    """The mask plus each quarter of the bits it leaves open."""
    left = [1 << i for i in range(BITS) if not mask >> i & 1]
    cuts = [round(len(left) * i / (DISTANCE + 1)) for i in range(DISTANCE + 2)]
    return sorted({mask | sum(left[a:b]) for a, b in zip(cuts, cuts[1:])})


def _dealt(rows: DataFrame, masks: list[int]) -> DataFrame:
    """(mask, pattern, fp): each fingerprint once for each finer mask of its own mask.

    The masks are at most four to the power of the level, whatever the data.
    """
    finer = F.create_map(
        *[
            c
            for m in masks
            for c in (
                F.lit(_signed(m)).cast("long"),
                F.array(*[F.lit(_signed(f)).cast("long") for f in finer_masks(m)]),
            )
        ]
    )
    each = rows.select(F.explode(F.element_at(finer, F.col("mask"))).alias("mask"), "fp")
    return each.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"), "fp")


class _Labels:
    """Components of numbered items; a label is the smallest number."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> bool:
        changed = False
        while True:
            x, y = self.of[a], self.of[b]
            apart = x != y
            if not apart.any():
                return changed
            changed = True
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.of[self.of]
                if (up == self.of).all():
                    break
                self.of = up


def _runs(starts: np.ndarray, n: int) -> np.ndarray:
    """Number of the run each of n places is in."""
    mark = np.zeros(n, np.int64)
    mark[starts] = 1
    return np.cumsum(mark) - 1


def _tree(group: np.ndarray, codes: np.ndarray) -> list[dict]:
    """Levels of nodes from the leaves up to one root a group. A node has the mask of the bits all
    its leaves share, their pattern there, and its first child."""
    full = np.full(len(codes), ~np.uint64(0))
    levels = [{"mask": full, "pattern": codes, "group": group, "child": np.arange(len(codes) + 1)}]
    while True:
        below = levels[-1]
        g = below["group"]
        begins = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        if len(begins) == len(g):
            return levels
        place = np.arange(len(g)) - begins[_runs(begins, len(g))]
        starts = np.flatnonzero(place % FANOUT == 0)
        first = below["pattern"][starts][_runs(starts, len(g))]
        shared = below["mask"] & ~(below["pattern"] ^ first)
        mask = np.bitwise_and.reduceat(shared, starts)
        levels.append({
            "mask": mask,
            "pattern": below["pattern"][starts] & mask,
            "group": g[starts],
            "child": np.r_[starts, len(g)],
        })


def _settled(levels: list[dict], labels: np.ndarray) -> None:
    """Give each node the label all its leaves have, or -1."""
    levels[0]["label"] = labels
    for below, level in zip(levels, levels[1:]):
        starts = level["child"][:-1]
        low = np.minimum.reduceat(below["label"], starts)
        high = np.maximum.reduceat(below["label"], starts)
        level["label"] = np.where(low == high, low, -1)


def _pairs_below(level: dict, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Children pairs of node pairs (each unordered pair once) and the pair each comes from."""
    first, number = level["child"][:-1], np.diff(level["child"])
    counts = number[a] * number[b]
    owner = np.repeat(np.arange(len(a)), counts)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    x = first[a[owner]] + k // number[b[owner]]
    y = first[b[owner]] + k % number[b[owner]]
    keep = (a[owner] != b[owner]) | (x <= y)
    return x[keep], y[keep], owner[keep]


def linked(group: np.ndarray, codes: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """For each code the first place it is connected with, by steps of at most ``distance`` bits
    within its group. Codes stand together by group and in Gray order within it."""
    labels = _Labels(len(codes))
    if len(codes) < 2:
        return labels.of
    # Gray neighbours first: they settle most of a dense group before any pair is formed.
    near = (group[1:] == group[:-1]) & (np.bitwise_count(codes[1:] ^ codes[:-1]) <= distance)
    at = np.flatnonzero(near)
    labels.join(at, at + 1)
    levels = _tree(group, codes)
    _settled(levels, labels.of)
    roots = np.arange(len(levels[-1]["mask"]))
    none = np.zeros(len(roots), np.uint64)
    stack = [(len(levels) - 1, roots, roots, none, none.astype(np.int64))]
    while stack:
        depth, a, b, known, differ = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [(depth, *(v[s] for v in (a, b, known, differ))) for s in (slice(half, None), slice(half))]
            continue
        level = levels[depth]
        shared = level["mask"][a] & level["mask"][b]
        new = (level["pattern"][a] ^ level["pattern"][b]) & shared & ~known
        differ = differ + np.bitwise_count(new)
        own = level["label"]
        open_ = (differ <= distance) & ~((own[a] == own[b]) & (own[a] >= 0))
        a, b, known, differ = a[open_], b[open_], shared[open_], differ[open_]
        if not len(a):
            continue
        if depth == 0:
            if labels.join(a, b):
                _settled(levels, labels.of)
            continue
        x, y, owner = _pairs_below(level, a, b)
        stack.append((depth - 1, x, y, known[owner], differ[owner]))
    return labels.of


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) for rows (mask, pattern, fp) that come sorted by node and Gray rank."""

    def found(mask: np.ndarray, pattern: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        node = _runs(np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])]), len(fp))
        several = np.bincount(node)[node] > 1
        node, fp = node[several], fp[several]
        label = linked(node, fp.view(np.uint64))
        other = label != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[other]), pa.array(fp[label[other]])], names=["u", "v"])

    held: list[np.ndarray] = [np.empty(0, np.int64)] * 3
    for batch in batches:
        held = [np.r_[h, c.to_numpy(zero_copy_only=False)] for h, c in zip(held, batch.columns)]
        mask, pattern, _ = held
        # The last node may go on in the next batch.
        differs = np.flatnonzero((mask != mask[-1]) | (pattern != pattern[-1])) if len(mask) else []
        if len(differs):
            cut = differs[-1] + 1
            yield found(*(h[:cut] for h in held))
            held = [h[cut:] for h in held]
    if len(held[0]):
        yield found(*held)


def links(distinct: DataFrame, node_size: int = NODE) -> DataFrame:
    """Edges (u, v) that connect the fingerprints of ``distinct`` (fp) as all links within three
    bits would."""
    edges, masks, level = None, [0], 0
    rows = _dealt(distinct.select(F.lit(0).cast("long").alias("mask"), "fp"), masks)
    while True:
        masks, level = sorted({f for m in masks for f in finer_masks(m)}), level + 1
        # Counted by partial aggregation on keys alone; only nodes above the size remain.
        sizes = rows.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node_size)
        large = written(sizes.select("mask", "pattern"), "large-nodes")
        refine = level < LEVELS and not large.isEmpty()
        small = rows.join(large, ["mask", "pattern"], "left_anti") if refine else rows
        order = small.select("mask", "pattern", "fp", gray_rank(F.col("fp")).alias("rank"))
        sorted_ = order.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", "rank")
        part = sorted_.select("mask", "pattern", "fp").mapInArrow(_edges, "u long, v long")
        edges = part if edges is None else edges.union(part)
        if not refine:
            return edges
        inside = rows.join(large, ["mask", "pattern"], "left_semi").select("mask", "fp")
        # A finer node can be reached by two ways; its fingerprints are the same.
        rows = written(_dealt(inside, masks).distinct(), "finer-nodes")


def classes(found: DataFrame, node_size: int = NODE) -> DataFrame:
    """(fp, component, component_id) of written fingerprints: component is a fingerprint that
    stands for the component, component_id its smallest document id."""
    distinct = found.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    distinct = written(distinct, "distinct-fingerprints")
    labels = components(links(distinct.select("fp"), node_size))
    own = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("component"), "first_id"
    )
    smallest = own.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return own.join(smallest, "component").select("fp", "component", "component_id")


def membership(docs: DataFrame, node_size: int = NODE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    found = written(fingerprints(docs), "fingerprints")
    joined = found.join(classes(found, node_size), "fp")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, node_size: int = NODE) -> DataFrame:
    """One document of each component with all its columns: the one with the smallest id (null ids
    last), of those one by a hash. Rows that agree in id and text count as one document."""
    found = written(fingerprints(docs), "fingerprints")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    kept = (
        found.join(classes(found, node_size), "fp")
        .groupBy("component")
        .agg(F.min(place).alias("best"))
        .select("best.k1", "best.k2")
    )
    id_ = F.col("doc_id").cast("long")
    rows = docs.select(
        F.xxhash64(id_, whole_text()).alias("k1"),
        F.xxhash64(F.lit(1), id_, whole_text()).alias("k2"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    return rows.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")
