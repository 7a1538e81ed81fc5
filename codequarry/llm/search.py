"""Ranked lexical search by the Best Position Algorithm over impact lists.

Each task takes its documents in shards of bounded size. In a shard every query term has a list of
its documents by falling impact (the term's weight times its saturated frequency, an integer). A
query reads its lists in parallel from the top, and looks each new document up in all its lists by
direct access, which both scores it and marks its positions as seen. The best position of a list is
the end of its unbroken run of seen positions; documents not seen lie behind it in every list, so
the sum of impacts at the best positions bounds their scores, and more tightly than the last
positions read would. A query stops when that bound is strictly below its k-th best score: equal
scores are settled by doc_id, so a bound that only reaches it isn't enough. The shards' winners meet
in two rank windows, first within salted parts of an item, then within the item.

Document frequencies and lengths are counted over all documents in a pass of their own. Queries are
taken in blocks of ``QUERY_BYTES`` of their text, one pass over the documents each, so what the
driver and the tasks hold of them is bounded; every item is asked.

Defined results: a null or empty text has no terms, and is no document for the statistics; a null
item text finds nothing. Each row of both tables counts by itself: repeated documents are ranked one
after the other, and repeated items each get a ranking. Equal scores follow doc_id, null first. Empty
tables give an empty result; other columns are left out, whatever their names. Texts are whole.
"""

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import blocks_of, texts, whole_text

# The characters that part terms, and the letters that are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
# Text in a shard, with so much more for each document; a task holds about 15 times as much.
SHARD_BYTES, ROW_BYTES = 16 << 20, 256
# Text of the queries of one pass.
QUERY_BYTES = 4 << 20
# Parts of an item's candidates that are ranked before they meet.
SALTS = 64
# Positions of each list read in the first round; each round reads twice as many.
FIRST_READ = 4

_FOUND = "item bigint, part int, doc_id bigint, score bigint"


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split() if text else []


def statistics(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents with terms, all their terms, and the documents of each word of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, length = Counter(), 0, 0
        for batch in batches:
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                n, length = n + bool(words), length + len(words)
                held.update(vocabulary.intersection(words))
        numbers = [n, length, *held.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([b"n", b"l", *(b"=" + t for t in held)], pa.binary()), pa.array(numbers, pa.int64())], ["what", "n"]
        )

    counted = texts(docs).select("text").mapInArrow(run, "what binary, n bigint").groupBy("what").agg(F.sum("n").alias("n"))
    sums = {bytes(r["what"]): r["n"] for r in counted.collect()}  # as many rows as the block's terms
    return sums.pop(b"n", 0), sums.pop(b"l", 0), {w[1:]: n for w, n in sums.items()}


def _weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Shard:
    """Impact lists of one shard's documents: entries by (term, falling impact, document)."""

    def __init__(self, whole: list[str], number: dict[bytes, int], weights: np.ndarray, n: int, length: int):
        docs, terms, sizes = [], [], []
        for text in whole:
            words = terms_of(text)
            sizes.append(len(words))
            terms.append(np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words)))
        sizes = np.array(sizes, np.int64)
        docs = np.repeat(np.arange(len(whole)), sizes)
        terms = np.concatenate([*terms, np.zeros(0, np.int64)])
        asked = terms >= 0
        key, tf = np.unique(terms[asked] * len(whole) + docs[asked], return_counts=True)
        term, self.doc = np.divmod(key, max(len(whole), 1))
        m = 100 - 75 + (75 * sizes * n) // max(length, 1)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc]))
        order = np.lexsort((self.doc, -impact, term))
        self.doc, self.impact = self.doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))

    def best(self, asked: np.ndarray, times: np.ndarray, k: int, ids_rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best documents (as places in the shard), their scores, and the positions read, for
        the terms ``asked`` (numbers) with their repeats; ties by ``ids_rank``."""
        starts, sizes = self.starts[asked], self.starts[asked + 1] - self.starts[asked]
        asked, times, starts, sizes = (x[sizes > 0] for x in (asked, times, starts, sizes))
        if not len(asked):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        ends = np.cumsum(sizes)
        first = ends - sizes
        entries = _ranges(starts, sizes)
        doc, impact = self.doc[entries], self.impact[entries] * np.repeat(times, sizes)
        # Direct access: a document's entries in all the lists.
        by_doc = np.argsort(doc, kind="stable")
        there, held = np.unique(doc, return_counts=True)
        held_from = np.cumsum(held) - held
        seen = np.zeros(len(doc), bool)
        unread = np.arange(len(doc))
        known = np.zeros(len(there), bool)
        scores = np.zeros(len(there), np.int64)
        slot = np.searchsorted(there, doc)
        depth, read, step = 0, 0, FIRST_READ
        while True:
            now = np.minimum(sizes - np.minimum(depth, sizes), step)
            sorted_access = _ranges(first + np.minimum(depth, sizes), now)
            read += len(sorted_access)
            depth, step = depth + step, step * 2
            fresh = np.unique(slot[sorted_access])
            fresh = fresh[~known[fresh]]
            if len(fresh):
                direct = by_doc[_ranges(held_from[fresh], held[fresh])]
                scores[fresh] = np.add.reduceat(impact[direct], np.cumsum(held[fresh]) - held[fresh])
                seen[direct] = known[fresh] = True
            # One behind the best position of each list; a list seen to its end bounds by nothing.
            behind = np.minimum.reduceat(np.where(seen, len(doc), unread), first)
            over = behind >= ends
            bound = int(np.where(over, 0, impact[np.maximum(behind - 1, first)]).sum())
            n_known = int(known.sum())
            if over.all() or (n_known >= k and np.partition(scores[known], n_known - k)[n_known - k] > bound):
                break
        winners = np.flatnonzero(known & (scores > 0))
        order = np.lexsort((ids_rank[there[winners]], -scores[winners]))[:k]
        return there[winners[order]], scores[winners[order]], read


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + sizes[0] - 1, starts[1] .., one behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _candidates(
    docs: DataFrame, asked: list[tuple[int, dict[bytes, int]]], k: int, shard_bytes: int
) -> DataFrame:
    """The k best documents of each shard for each item of a block of queries."""
    number = {t: i for i, t in enumerate(sorted({t for _, q in asked for t in q}))}
    n, length, df = statistics(docs, set(number))
    weights = np.array([_weight(n, df.get(t, 0)) for t in number], np.int64)
    queries = [(item, np.array([number[t] for t in q]), np.array([*q.values()], np.int64)) for item, q in asked if q]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % SALTS
        for table in blocks_of(batches, shard_bytes, ROW_BYTES):
            shard = Shard(table["text"].to_pylist(), number, weights, n, length)
            ids = table["doc_id"].combine_chunks()
            there = ids.is_valid().to_numpy(zero_copy_only=False)
            plain = ids.fill_null(0).to_numpy()
            rank = np.empty(len(ids), np.int64)
            rank[np.lexsort((plain, there))] = np.arange(len(ids))
            items, places, scores = [], [], []
            for item, terms, times in queries:
                place, score, _ = shard.best(terms, times, k, rank)
                items += [item] * len(place)
                places.append(place)
                scores.append(score)
            places, scores = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (places, scores))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), pa.array([part] * len(items), pa.int32()), ids.take(pa.array(places)), pa.array(scores)],
                ["item", "part", "doc_id", "score"],
            )

    return texts(docs).mapInArrow(run, _FOUND)


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, shard_bytes: int = SHARD_BYTES, query_bytes: int = QUERY_BYTES
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with scores above zero.

    ``docs`` has doc_id and text, ``items`` item_id and text. Statistics are counted, and items
    read, when this is called.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / query_bytes))
    found, names = None, []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        asked = [(len(names) + i, dict(Counter(terms_of(r["text"])))) for i, r in enumerate(rows)]
        names += [r["item_id"] for r in rows]
        part = _candidates(docs, asked, k, shard_bytes)
        found = part if found is None else found.unionByName(part)
    for keys in (("item", "part"), ("item",)):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    numbered = docs.sparkSession.createDataFrame(list(enumerate(names)), "item bigint, item_id bigint")
    return found.join(numbered, "item").select("item_id", "rank", "doc_id", "score")
