"""Repeated passages removed by prefix-free parsing.

A byte goes when a string of ``LENGTH`` bytes over it also starts earlier in the corpus. The order
of all such strings comes out of a parse of the texts:

- *Triggers.* A rolling hash runs over every ``WINDOW`` bytes. In each string of ``LENGTH`` bytes
  the place with the smallest hash, the leftmost of equals, is its trigger, so equal strings have
  their trigger at the same place whatever stands around them. Triggers cut the texts into phrases.
- *Dictionary and parse.* A string is a phrase's end (what stands before the trigger, the trigger
  in it) followed by the beginning of the parse behind it. Around each trigger stands a core that
  all its strings share: 54 bytes from the trigger on for those that begin near it, 54 bytes up to
  it for the others. Cores that occur once in the corpus are no part of a repeated string and go no
  further; this leaves a small part of a corpus.
- *Suffix arrays.* Occurrences that share a core (by its digest) are dealt together, with the bytes
  around it that their strings have. Sorting them by what stands before the core, read backward, is
  the suffix array of the dictionary: one order with its common lengths names every phrase end of
  every length. Sorting them by what follows is the suffix array of the parse. A pair of names, so
  many bytes before and the rest behind, is a class of equal strings; its earliest member stays, and
  all others are repeats.

Texts are read in blocks, dealt by row, not by key, so a group of copies is spread over all blocks;
a block asks for its cores once however often it has them. A core that occurs more than
``GROUP`` times is dealt into salted parts: each part finds its earliest strings, and these few meet
again by their digest. The blocks' one shuffle of texts serves the three steps that need them.

Defined results: a null text is empty; one with fewer than ``LENGTH`` bytes keeps all. Documents are
ordered by id, null first; rows that share an id follow each other as they do in the table, and the
later ones repeat the earlier. Each row gives a row. An empty table gives an empty result; other columns are left out,
whatever their names. ``docs`` has to give the same rows in the same order when a lost task reads
them again, as files do.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import texts

LENGTH = 100
# Bytes that the rolling hash covers, and places a string has for its trigger.
WINDOW = 8
PLACES = LENGTH - WINDOW + 1
# A core's bytes, and how many bytes its strings have before or behind it.
CORE, REACH = 54, 46
# Bytes of text in a block; a task holds one at a time, with about 60 bytes an input byte.
BLOCK_BYTES = 4 << 20
# Occurrences of a core that one part takes.
GROUP = 1 << 12
# Occurrences that are sorted at once.
SORTED = 1 << 16
# String starts whose triggers are searched at once.
_CHUNK = 1 << 22

_SIDE = (b"near", b"far")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

_KEYS = "of bigint, key bigint, times bigint"
_SPOT = "row bigint, doc_id bigint, base bigint"
_LIVE = f"core binary, salt int, salts int, {_SPOT}, low int, high int, before binary, behind binary"
_VERDICT = f"{_SPOT}, mask bigint, digest binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


class Block:
    """A block's texts as one array of bytes, with LENGTH zeros on either side."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.row = table["row"].to_numpy()
        self.doc_id = table["doc_id"]
        whole = [t.as_buffer() if t.is_valid else b"" for t in table["text"].cast(pa.large_binary())]
        self.sizes = np.array([len(w) for w in whole], np.int64)
        self.bytes = np.frombuffer(b"".join([bytes(LENGTH), *whole, bytes(LENGTH)]), np.uint8)
        self.starts = LENGTH + np.cumsum(self.sizes) - self.sizes


def _hashes(data: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """Mixed polynomial hash of ``width`` bytes from each place, or from the places ``at``."""
    if at is None:
        h = np.zeros(len(data) - width + 1, np.uint64)
        for j in range(width):
            h *= _BASE
            h += data[j : j + len(h)]
    else:
        h = np.zeros(len(at), np.uint64)
        for j in range(width):
            h *= _BASE
            h += data[at + j]
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def triggers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the strings within texts from ``starts`` to ``ends``: each trigger with the first and last
    string start whose trigger it is."""
    found = []
    for lo in range(LENGTH, max(len(data) - 2 * LENGTH + 1, LENGTH), _CHUNK):
        hi = min(lo + _CHUNK, len(data) - 2 * LENGTH + 1)
        # The high bits of the hash before the place: the least is the leftmost of the smallest.
        least = _hashes(data[lo : hi + LENGTH - 1], WINDOW) & ~np.uint64(2**23 - 1)
        least |= np.arange(len(least), dtype=np.uint64)
        width = 1
        while 2 * width <= PLACES:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: hi - lo], least[PLACES - width : PLACES - width + hi - lo])
        found.append((least & np.uint64(2**23 - 1)).astype(np.int64) + lo)
    trigger = np.concatenate([*found, np.zeros(0, np.int64)])
    # Only strings that end in the text they start in.
    edge = np.zeros(len(trigger) + 1, np.int64)
    long = ends - starts >= LENGTH
    np.add.at(edge, starts[long] - LENGTH, 1)
    np.add.at(edge, ends[long] - 2 * LENGTH + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:-1]))
    trigger = trigger[at]
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(trigger) != 0) | (np.diff(at) != 1)
    last = np.roll(first, -1)
    return trigger[first], at[first] + LENGTH, at[last] + LENGTH


def occurrences(block: Block) -> dict[str, np.ndarray]:
    """Each core with a place, REACH bytes before it, and its strings' first and last start, counted
    from there."""
    at, first, last = triggers(block.bytes, block.starts, block.starts + block.sizes)
    near, far = at - REACH, at - 2 * REACH - 1
    sides = []
    for base, low, high, side in (
        (near, np.maximum(first, near), last, 0),
        (far, first, np.minimum(last, far + REACH), 1),
    ):
        there = low <= high
        key = _hashes(block.bytes, CORE, base[there] + REACH) ^ np.uint64(side)
        sides.append((base[there], (low - base)[there], (high - base)[there], key.view(np.int64), np.full(len(key), side)))
    return dict(zip(("base", "low", "high", "key", "side"), (np.concatenate(x) for x in zip(*sides))))


def _keys_of(table: pa.Table) -> pa.Table:
    """A block's distinct cores and how often it has them."""
    keys, times = np.unique(occurrences(Block(table))["key"], return_counts=True)
    return pa.table({"of": np.full(len(keys), table["block"][0].as_py()), "key": keys, "times": times})


def _live_in(left: pa.Table, right: pa.Table, group: int) -> pa.Table:
    """A block's occurrences of cores that are asked for."""
    if not len(left) or not len(right):
        types = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        return pa.table({c.split()[0]: pa.array([], types[c.split()[1]]) for c in _LIVE.split(", ")})
    block = Block(left)
    wanted = right["key"].to_numpy()
    order = np.argsort(wanted)
    wanted, total = wanted[order], right["total"].to_numpy()[order]
    found = occurrences(block)
    at = np.minimum(np.searchsorted(wanted, found["key"]), len(wanted) - 1)
    live = np.flatnonzero(wanted[at] == found["key"])
    base, low, high = (found[c][live] for c in ("base", "low", "high"))
    salts = -(-total[at[live]] // group)
    # A text's occurrences of a core may be any number as well: parts are dealt by place.
    spread = (block.starts.searchsorted(base + low, side="right") - 1).astype(np.int64)
    mixed = ((block.row[spread] + base * 7) & 0x7FFFFFFF) % salts
    data, at = block.bytes.tobytes(), (base + REACH).tolist()
    first, last = (base + low).tolist(), (base + high + LENGTH).tolist()
    return pa.table({
        "core": pa.array([hashlib.blake2b(data[i : i + CORE], digest_size=16, salt=_SIDE[k]).digest() for i, k in zip(at, found["side"][live].tolist())], pa.binary()),
        "salt": mixed.astype(np.int32), "salts": salts.astype(np.int32),
        "row": block.row[spread], "doc_id": block.doc_id.take(pa.array(spread)), "base": base - block.starts[spread],
        "low": low.astype(np.int32), "high": high.astype(np.int32),
        "before": pa.array([data[i:j] for i, j in zip(first, at)], pa.binary()),
        "behind": pa.array([data[i + CORE : j] for i, j in zip(at, last)], pa.binary()),
    })


def _ordered(group: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the rows of ``side`` within their groups, and in it the bytes that each row
    has in common with the one before it; less than none where a group starts."""
    width = 8 + side.shape[1]
    rows = np.empty((len(side), width), np.uint8)
    rows[:, :8] = group.astype(">u8").view(np.uint8).reshape(-1, 8)
    rows[:, 8:] = side
    order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
    rows = rows[order]
    differs = rows[1:] != rows[:-1]
    common = np.where(differs.any(1), differs.argmax(1), width)
    return order, np.concatenate([[0], common]) - 8


def classes(group: np.ndarray, before: np.ndarray, behind: np.ndarray, low: np.ndarray, high: np.ndarray, rank: np.ndarray):
    """Repeats among occurrences: a mask of starts for each, and (occurrences, start) of all others.

    ``group`` numbers the cores, ``before`` and ``behind`` are the bytes next to them, from the core
    on, ``rank`` the places in corpus order.
    """
    before, before_common = _ordered(group, before)
    behind, behind_common = _ordered(group, behind)
    mask = np.zeros(len(group), np.int64)
    kept = []
    name_before, name_behind = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    for start in range(REACH + 1):
        there = np.flatnonzero((low <= start) & (start <= high))
        if not len(there):
            continue
        name_before[before] = np.cumsum(before_common < REACH - start)
        name_behind[behind] = np.cumsum(behind_common < start)
        name = name_before[there] * (len(group) + 1) + name_behind[there]
        order = np.lexsort((rank[there], name))
        earliest = np.ones(len(there), bool)
        earliest[1:] = np.diff(name[order]) != 0
        mask[there[order[~earliest]]] |= np.int64(1) << np.int64(start)
        kept.append((there[order[earliest]], start))
    return mask, kept


def _side_by_side(strings: pa.Array, backward: bool) -> np.ndarray:
    """Strings of up to REACH bytes as rows, from their first byte or from their last one on."""
    sizes = pc.binary_length(strings).to_numpy()
    there = np.arange(REACH) < sizes[:, None]
    rows = np.zeros((len(strings), REACH), np.uint8)
    data = np.frombuffer(b"".join(strings.to_pylist()), np.uint8)
    if backward:
        at = np.repeat(np.cumsum(sizes), sizes) - 1 - (np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
        data = data[at]
    rows[there] = data
    return rows


def _new_parts(table: pa.Table) -> np.ndarray:
    """Whether a row's (core, salt) differs from the row's before it."""
    core, salt = table["core"].combine_chunks(), table["salt"].to_numpy()
    new = np.zeros(len(table), bool)
    new[1:] = pc.not_equal(core[1:], core[:-1]).to_numpy(zero_copy_only=False) | (np.diff(salt) != 0)
    return new


def _sorted_parts(batches):
    """Arrow batches in order of (core, salt) as tables of whole parts."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < SORTED:
            continue
        table = pa.Table.from_batches(held)
        new = _new_parts(table)
        if new.any():
            cut = int(np.flatnonzero(new)[-1])
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            rows = sum(b.num_rows for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _verdicts(batches):
    for table in _sorted_parts(batches):
        table = table.combine_chunks()
        n = len(table)
        before, behind = (table[c].combine_chunks() for c in ("before", "behind"))
        salts, low, high, row, base = (table[c].to_numpy() for c in ("salts", "low", "high", "row", "base"))
        doc_id = table["doc_id"]
        there, plain = doc_id.is_valid().to_numpy(), doc_id.fill_null(0).to_numpy()
        rank = np.empty(n, np.int64)
        rank[np.lexsort((base, row, plain, there))] = np.arange(n)
        group = np.cumsum(_new_parts(table))
        mask, kept = classes(group, _side_by_side(before, True), _side_by_side(behind, False), low, high, rank)
        # Earliest strings of a salted part meet those of the others; the rest is settled.
        at, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, start in kept:
            first = first[salts[first] > 1]
            at.append(first)
            starts.append(np.full(len(first), start))
        at, starts = np.concatenate(at), np.concatenate(starts)
        digests = []
        for i, start in zip(at.tolist(), starts.tolist()):
            left, right = before[i].as_py(), behind[i].as_py()
            whole = left[len(left) - (REACH - start) :] + right[:start]
            digests.append(hashlib.blake2b(table["core"][i].as_py() + bytes([start]) + whole, digest_size=16).digest())
        settled = np.flatnonzero(mask)
        take = pa.array(np.concatenate([settled, at]))
        spots = table.select(["row", "doc_id", "base"]).take(take)
        spots = spots.append_column("mask", pa.array(np.concatenate([mask[settled], np.int64(1) << starts])))
        spots = spots.append_column("digest", pa.array([None] * len(settled) + digests, pa.binary()))
        yield from spots.combine_chunks().to_batches()


def _removed(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents without their repeats."""
    block = Block(left)
    cover = np.zeros(len(block.bytes) + 1, np.int64)
    if len(right):
        order = np.argsort(block.row)
        text = order[np.searchsorted(block.row[order], right["row"].to_numpy())]
        mask = right["mask"].to_numpy()
        base = block.starts[text] + right["base"].to_numpy()
        for start in range(REACH + 1):
            at = base[(mask >> start) & 1 == 1] + start
            np.add.at(cover, at, 1)
            np.add.at(cover, at + LENGTH, -1)
    gone = np.cumsum(cover[:-1]) > 0
    # A run ends where its text does.
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    begins[block.starts[block.sizes > 0]] = gone[block.starts[block.sizes > 0]]
    ends = block.starts + block.sizes
    n_removed, n_spans = (
        np.concatenate([[0], np.cumsum(x)])[ends] - np.concatenate([[0], np.cumsum(x)])[block.starts] for x in (gone, begins)
    )
    digests = [hashlib.sha256(block.bytes[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(block.starts.tolist(), ends.tolist())]
    return pa.table({
        "doc_id": left["doc_id"], "n_bytes": block.sizes, "n_removed": n_removed, "n_spans": n_spans, "kept_sha256": digests,
    })


def repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES, group: int = GROUP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    thin = texts(docs)
    size = thin.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    block_of = F.pmod(F.xxhash64("row"), F.lit(n)).cast("long")
    dealt = thin.withColumn("row", F.monotonically_increasing_id()).withColumn("block", block_of)
    blocks = dealt.select("block", "row", "doc_id", "text").groupBy("block")
    keys = blocks.applyInArrow(_keys_of, _KEYS)
    asked = keys.withColumn("total", F.sum("times").over(Window.partitionBy("key"))).where("total > 1")
    live = blocks.cogroup(asked.select("of", "key", "total").groupBy("of")).applyInArrow(
        lambda key, left, right: _live_in(left, right, group), _LIVE
    )
    parts = live.repartition("core", "salt").sortWithinPartitions("core", "salt")
    verdicts = parts.mapInArrow(_verdicts, _VERDICT)
    # Where there is a digest, the string of that place is a repeat unless it is the earliest.
    meets = F.when(F.col("digest").isNull(), F.col("row")).otherwise(F.xxhash64("digest"))
    earlier = Window.partitionBy("meets", "digest").orderBy(F.asc_nulls_first("doc_id"), "row", "base", "mask")
    ranked = verdicts.withColumn("meets", meets).withColumn("nth", F.row_number().over(earlier))
    masks = ranked.where("digest IS NULL OR nth > 1").select(block_of.alias("of"), "row", "base", "mask")
    return blocks.cogroup(masks.groupBy("of")).applyInArrow(_removed, RESULT)
