"""What several operators of this subpackage share."""

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Longest array built to repeat one row; more copies take several such arrays.
REPEAT = 1 << 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, null text as empty; whatever else ``docs`` has cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def repeated(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its column ``copies`` says, numbered from 0 in a column ``copy``."""
    chunk = F.lit(REPEAT).cast("long")
    last = F.col(copies) - F.lit(1)
    per_chunk = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / chunk))))
    first = F.col("_chunk") * chunk
    end = F.least(first + chunk - F.lit(1), last)
    return per_chunk.withColumn("copy", F.explode(F.sequence(first, end))).drop("_chunk", copies)


def per_batch(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """``fn`` over each Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)


def blocks_of(batches: Iterator[pa.RecordBatch], limit: int, row: int = 0) -> Iterator[pa.Table]:
    """Rows in order as tables of at most ``limit`` bytes of text, or of one longer text; each row
    counts ``row`` bytes more."""
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        start = 0
        for k, more in enumerate(sizes.tolist()):
            more += row
            if size and size + more > limit:
                yield pa.Table.from_batches([*held, batch.slice(start, k - start)])
                held, size, start = [], 0, k
            size += more
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
