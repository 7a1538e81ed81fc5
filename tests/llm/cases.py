"""Documents that are awkward in every way the operators promise to handle."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("lang", "source")]
    + [T.StructField("n_chars", T.LongType())]
    # Names the operators use inside.
    + [T.StructField(c, T.StringType()) for c in ("digest", "record", "words", "kept", "m")]
)

LONG = "Tall ships sail past the old harbour wall while gulls argue over bread. " * 4000
ONE_WORD = "x" * 300_000

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (3, "the quick brown fox jumps over the lazy dog near the river bank today."),
    (4, None),
    (5, ""),
    (6, "   \n\t "),
    (None, "A text without an id, released under the MIT License."),
    (None, None),
    (7, LONG),
    (8, LONG),
    (9, ONE_WORD),
    (10, "naïve café — 日本語 text\u0000with\u0085odd spaces\r\nand 😀 signs"),
    (-3, "negative ids are ids too"),
    (11, "negative ids are ids too"),
    (12, "<|endoftext|> and don't I'll we've 12345 !!!   "),
]


def awkward(spark):
    rows = [(i, t, "en" if t else None, None, len(t) if t is not None else None, "d", "r", None, "k", "m") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def plain(df):
    """(doc_id, text or '') of all rows, on the driver."""
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def bag(rows):
    return sorted(map(repr, rows))
