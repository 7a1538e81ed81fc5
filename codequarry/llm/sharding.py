"""Sharding by a two-pass external shuffle, native.

Pass one scatters the records uniformly over as many buckets as keep each near ``bucket_bytes``;
pass two reads a bucket into memory, Fisher-Yates shuffles it (Spark's ``shuffle``) and writes it.
The written buckets, end to end, are one random permutation of all records; place g of it goes to
shard ``g mod shards``, slot ``g div shards``, so shard sizes in rows differ by one at most.

Buckets are chosen by a seeded hash of a row's place in the table, so rows spread alike whatever
they hold, equal ones too. A lost task that reads the same files again scatters its rows the same
way; since the buckets are written before offsets are given, a retried task cannot change an order
that was already used. There are as many tasks as buckets up to ``MOST_TASKS``, and a task holds at
most ``HELD`` buckets' arrays however many it was dealt.

Defined results: a null text has no bytes (size 16) and checksum 0; rows may repeat and each gets a
slot; ids may be null; an empty table gives an empty result; other columns are carried along
unchanged whatever their names, but must be of types that Spark can order.
"""

import contextlib
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import written
from .common import whole_text

# A bucket's records are held as one array, so this bounds a task's memory.
BUCKET_BYTES = 16 << 20
# Tasks of the second pass, one for each bucket up to here.
MOST_TASKS = 1 << 16
# Buckets that a task holds side by side; dealt more, it sorts its rows by bucket, on disk if need be,
# and then holds one at a time.
HELD = 6
# Spark's name for that limit.
_SIDE_BY_SIDE = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
# Offsets are 16 bytes a bucket; up to here they are broadcast (a MiB), beyond joined.
BROADCAST_BUCKETS = 1 << 16
ROW_OVERHEAD = 16


def buckets(docs: DataFrame, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """The written, shuffled buckets (bucket, pos, record) and their number."""
    size = F.octet_length(whole_text()).cast("long") + F.lit(ROW_OVERHEAD)
    total = docs.agg(F.sum(size)).first()[0] or 0
    n = max(1, math.ceil(total / bucket_bytes))
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    keyed = docs.select(record, F.monotonically_increasing_id().alias("place"))
    keyed = keyed.select(F.struct(F.xxhash64(F.lit(seed), "place").alias("key"), "place", "record").alias("entry"))
    tasks = min(n, MOST_TASKS)
    bucket = F.pmod("entry.key", F.lit(n))
    scattered = keyed.select(bucket.alias("bucket"), F.pmod(bucket, F.lit(tasks)).cast("int").alias("task"), "entry")
    # Dealt by number, not by its hash: a task has its own buckets and no other's.
    listed = scattered.repartitionById(tasks, F.col("task")).groupBy("task", "bucket").agg(
        F.sort_array(F.collect_list("entry")).alias("entries")
    )
    mixed = listed.select("bucket", F.shuffle("entries", seed=seed).alias("entries"))
    placed = mixed.select("bucket", F.posexplode("entries").alias("pos", "entry"))
    with _setting(docs.sparkSession, _SIDE_BY_SIDE, str(HELD)):
        return written(placed.select("bucket", "pos", "entry.record"), "shard-buckets"), n


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def sharded(
    docs: DataFrame, shards: int = 40, seed: int = 0, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """(record, shard, slot): every record of ``docs`` as a struct, with its place."""
    placed, n = buckets(docs, seed, bucket_bytes)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    # One thin row per bucket: the only window without a partition, and it never sees a record.
    offsets = counts.select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    # Counted above, so known to be small; left to sizes, both sides would be shuffled first.
    offsets = F.broadcast(offsets) if n <= BROADCAST_BUCKETS else offsets
    place = F.col("first") + F.col("pos")
    return placed.join(offsets, "bucket").select(
        "record",
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        F.floor(place / F.lit(shards)).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, seed: int = 0) -> None:
    """Write ``path/shard=k/`` with (slot, record) of shard k in slot order."""
    rows = sharded(docs, shards, seed).select("shard", "slot", "record")
    ordered = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


def places(docs: DataFrame, shards: int = 40, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = whole_text(F.col("record.text"))
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return sharded(thin, shards, seed, bucket_bytes).select(
        "record.doc_id",
        (F.octet_length(text).cast("long") + F.lit(ROW_OVERHEAD)).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
    )
