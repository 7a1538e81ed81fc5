"""Packing documents into sequences by a grouping genetic algorithm on islands.

Documents are tokenised where they are read, longer ones cut to pieces of a whole sequence (the
first piece takes the rest), and only piece lengths go on. Pieces that fill a sequence have one to
themselves. The others are dealt by a seeded hash into blocks of about ``block_items``; each block
is packed on several islands (tasks). An island's population starts from best-fit packings in
varied orders. Crossover puts whole well-filled bins of one packing into another, takes out the
bins that hold their documents already, and best-fits what was displaced, longest first. After a
round each island sends its best packing to the next one. A block's best packing stays.

Blocks leave a few badly filled bins each. Their pieces are gathered and packed again in blocks,
with the old bins as one more ancestor, so a level never needs more bins than it got; this ends
when they fit one block or stop shrinking.

Defined results: a null text counts as empty and is the one separator token; rows may repeat and
each is packed; null ids are fine; an empty table gives an empty result; other columns never
matter. A piece never shares its place; offsets in a sequence are gapless from 0.
"""

import hashlib
import random
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written
from . import encoders
from .common import texts

CAPACITY = 2048
SEPARATOR = 0
# Expected pieces of a block: what one task holds.
BLOCK_ITEMS = 4096
ISLANDS = 2
ROUNDS = 2
POPULATION = 4
GENERATIONS = 6
# Share of a parent's well-filled bins that crossover injects, and what counts as well filled.
INJECTED = 0.3
WELL_FILLED = 0.995
# Bins filled less are packed again on the next level, of at most LEVELS.
LOOSE = 0.97
LEVELS = 4

Bins = list[list[int]]


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first takes what whole pieces leave."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    starts = [0, *range(first, n_tokens, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_tokens])]


def pieces(docs: DataFrame, source: bytes, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): ids end with the separator; ``with_ids`` adds the
    ids themselves as little-endian 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(source)  # the tokenizer file, a few MiB at most
    version = hashlib.sha256(source).hexdigest()
    separator, width = SEPARATOR.to_bytes(encoders.WIDTH, "little"), encoders.WIDTH
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            encoder = encoders.loaded(version, shared.value)
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids = encoder.ids(text) + separator
                for k, (start, length) in enumerate(cut(len(ids) // width, capacity)):
                    own = ids[start * width : (start + length) * width]
                    rows.append((doc_id, k, start, length, zlib.crc32(own), own)[: len(names)])
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return texts(docs).mapInArrow(batches, schema)


def best_fit(bins: Bins, items: list[int], lengths: list[int], capacity: int) -> Bins:
    """Put each item, in the given order, into the bin it fills best, or a new one."""
    free = [capacity - sum(map(lengths.__getitem__, b)) for b in bins]
    having: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has r tokens free
    for k, room in enumerate(free):
        having.setdefault(room, []).append(k)
        rooms |= 1 << room
    for item in items:
        length = lengths[item]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            same = having[room]
            k = same.pop()
            if not same:
                rooms ^= 1 << room
            bins[k].append(item)
            room -= length
        else:
            k, room = len(bins), capacity - length
            bins.append([item])
        having.setdefault(room, []).append(k)
        rooms |= 1 << room
    return bins


def fitness(bins: Bins, lengths: list[int]) -> tuple[int, int]:
    """Fewer bins, then fuller full ones."""
    return -len(bins), sum(sum(map(lengths.__getitem__, b)) ** 2 for b in bins)


def crossover(into: Bins, source: Bins, lengths: list[int], capacity: int, rnd: random.Random) -> Bins:
    full = [b for b in source if sum(map(lengths.__getitem__, b)) >= WELL_FILLED * capacity]
    injected = [b for b in full if rnd.random() < INJECTED]
    there = {i for b in injected for i in b}
    child, displaced = [list(b) for b in injected], []
    for b in into:
        if there.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in there]
    displaced.sort(key=lengths.__getitem__, reverse=True)
    return best_fit(child, displaced, lengths, capacity)


def evolved(
    lengths: list[int], population: list[Bins], seed: int, capacity: int, generations: int = GENERATIONS
) -> list[Bins]:
    """The population after some generations, best first; ends early at the least possible bins."""
    rnd = random.Random(seed)
    order = sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True)
    while len(population) < POPULATION:
        # The plain longest-first order once, then orders that stray from it.
        spread = 0.3 * len(population)
        key = {i: lengths[i] * (1 + spread * rnd.random()) for i in order}
        population.append(best_fit([], sorted(order, key=key.__getitem__, reverse=True), lengths, capacity))
    ranked = sorted(((fitness(b, lengths), b) for b in population), key=lambda x: x[0], reverse=True)
    least = -(-sum(lengths) // capacity)
    for _ in range(generations):
        if len(ranked[0][1]) <= least:
            break
        a, b = rnd.sample(range(len(ranked)), 2)
        child = crossover(ranked[a][1], ranked[b][1], lengths, capacity, rnd)
        ranked.append((fitness(child, lengths), child))
        ranked.sort(key=lambda x: x[0], reverse=True)
        ranked.pop()
    return [b for _, b in ranked]


def _as_bins(of_item: list[int]) -> Bins:
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(of_item):
        bins.setdefault(k, []).append(i)
    return list(bins.values())


def _of_item(bins: Bins, n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


ISLAND = "block long, island int, items array<struct<uid:long,length:long,bin:long>>, packings array<array<int>>"


def _island_round(capacity: int, seed: int, rank: int):
    """Evolve each row's population; the best packing comes first."""
    types = {
        "block": pa.int64(), "island": pa.int32(),
        "items": pa.list_(pa.struct([("uid", pa.int64()), ("length", pa.int64()), ("bin", pa.int64())])),
        "packings": pa.list_(pa.list_(pa.int32())),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, island, items, packings = (c[row].as_py() for c in batch.columns)
                lengths = [i["length"] for i in items]
                population = [_as_bins(p) for p in packings or []]
                if not population and items[0]["bin"] is not None:
                    population = [_as_bins([i["bin"] for i in items])]
                population = evolved(lengths, population, hash((seed, rank, block, island)), capacity)
                out = [_of_item(b, len(lengths)) for b in population[:POPULATION]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip((block, island, items, out), types.values())], names=list(types)
                )

    return run


def _packed_blocks(items: DataFrame, blocks: int, capacity: int, seed: int, islands: int, rounds: int) -> DataFrame:
    """(block, items, packing) of items (uid, length, bin): the best packing of each block."""
    entry = F.struct("uid", "length", "bin")
    # Bins of the level before stay together, or they could not serve as an ancestor.
    key = F.coalesce("bin", "uid")
    dealt = items.select(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(blocks)).alias("block"), entry.alias("entry"))
    listed = dealt.repartition("block").groupBy("block").agg(F.sort_array(F.collect_list("entry")).alias("items"))
    now = listed.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        "items",
        F.lit(None).cast("array<array<int>>").alias("packings"),
    ).repartition("block", "island")
    for rank in range(rounds):
        now = now.mapInArrow(_island_round(capacity, seed, rank), ISLAND)
        if rank + 1 < rounds:
            # All packings stay at home; the best also goes to the next island.
            own = F.struct(F.col("island").alias("to"), F.col("packings").alias("packings"))
            on = F.struct(
                F.pmod(F.col("island") + 1, F.lit(islands)).alias("to"), F.slice("packings", 1, 1).alias("packings")
            )
            sent = now.select("block", "items", F.explode(F.array(own, on) if islands > 1 else F.array(own)).alias("sent"))
            now = sent.groupBy("block", F.col("sent.to").alias("island")).agg(
                F.first("items").alias("items"), F.flatten(F.collect_list("sent.packings")).alias("packings")
            )
    best = now.select("block", "island", "items", F.col("packings")[0].alias("packing"))
    n_bins = F.array_max("packing")
    return best.groupBy("block").agg(
        F.min_by("items", F.struct(n_bins, "island")).alias("items"),
        F.min_by("packing", F.struct(n_bins, "island")).alias("packing"),
    )


def assigned(
    items: DataFrame,
    capacity: int = CAPACITY,
    seed: int = 0,
    block_items: int = BLOCK_ITEMS,
    islands: int = ISLANDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(uid, sequence_id, offset) for items (uid, length) with unique uids, at most ``capacity`` long."""
    whole = items.where(F.col("length") == capacity).select(
        "uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    done = [whole]
    left = items.where(F.col("length") < capacity).select("uid", "length", F.lit(None).cast("long").alias("bin"))
    n_left = left.count()
    for level in range(LEVELS):
        if not n_left:
            break
        blocks = max(1, round(n_left / block_items))
        best = _packed_blocks(left, blocks, capacity, seed + level, islands, rounds)
        rows = best.select("block", F.explode(F.arrays_zip("items", "packing")).alias("z")).select(
            F.col("z.items.uid").alias("uid"),
            F.col("z.items.length").alias("length"),
            # Unique over levels, and negative where whole pieces have their uid.
            (F.lit(-1) - ((F.col("block") * F.lit(LEVELS) + F.lit(level)) * F.lit(1 << 24) + F.col("z.packing"))).alias("bin"),
        )
        one = Window.partitionBy("bin")
        before = one.orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
        packed = written(
            rows.withColumns({
                "offset": F.coalesce(F.sum("length").over(before), F.lit(0)),
                "fill": F.sum("length").over(one),
            }),
            "packed-bins",
        )
        last = blocks == 1 or level + 1 == LEVELS
        loose = F.lit(False) if last else F.col("fill") < F.lit(LOOSE * capacity)
        done.append(packed.where(~loose).select("uid", F.col("bin").alias("sequence_id"), "offset"))
        left = packed.where(loose).select("uid", "length", "bin")
        n_left = left.count()
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack(docs: DataFrame, source: bytes, capacity: int = CAPACITY, seed: int = 0, **how: int) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    made = written(
        pieces(docs, source, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces"
    )
    places = assigned(made.select("uid", "length"), capacity, seed, **how)
    return made.join(places, "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
