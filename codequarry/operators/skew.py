"""Joins that hold up when one key owns a large share of the rows.

A join with a table of one row per key is left to Spark as it is: adaptive execution broadcasts a
small side and splits the partition of a hot key on the other, both by sizes measured at run time.
Only a join in which a key has many rows on *both* sides needs more, since its rows multiply:
``skew_join`` cuts such keys into cells.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that one cell takes from either side; a cell makes at most the square of it.
SIDE = 2_000


def cells(left: DataFrame, right: DataFrame, on: list[str], side: int = SIDE) -> DataFrame:
    """Keys whose two sides together make more than ``side`` squared rows, and the number of parts
    each side is cut into: in proportion to its rows, so no cell exceeds the limit.

    Both sides are counted by partial aggregation on the key columns; nothing comes to the driver
    and no job runs until the join does.
    """
    n_left = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n_left"))
    n_right = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n_right"))
    hot = n_left.join(n_right, on).where(
        F.col("_n_left").cast("double") * F.col("_n_right") > float(side) ** 2
    )
    return hot.select(
        *on,
        F.ceil(F.col("_n_left") / side).cast("int").alias("_left_parts"),
        F.ceil(F.col("_n_right") / side).cast("int").alias("_right_parts"),
    )


def skew_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_left: list[str], spread_right: list[str], side: int = SIDE
) -> DataFrame:
    """Inner equi-join in which keys with many rows on both sides are cut into cells.

    A row of a hot key takes the part of its own side that its ``spread`` columns hash to (the same
    one again in a re-run task) and goes to all parts of the other side; each pair of rows meets in
    exactly one cell. Rows of all other keys join as usual and nothing of them is repeated.
    """
    hot = cells(left, right, on, side)

    def dealt(df: DataFrame, own: str, other: str, spread: list[str]) -> DataFrame:
        # Hot keys are fewer than both sides' rows over ``side``: a table to send, not to move rows for.
        marked = df.join(F.broadcast(hot), on, "left")
        parts = F.coalesce(F.col(f"_{own}_parts"), F.lit(1))
        mine = F.pmod(F.xxhash64(*spread), parts).cast("int").alias(f"_{own}_part")
        theirs = F.sequence(F.lit(0), F.coalesce(F.col(f"_{other}_parts"), F.lit(1)) - 1)
        return marked.select(*df.columns, mine, F.explode(theirs).alias(f"_{other}_part"))

    cut = dealt(left, "left", "right", spread_left)
    met = dealt(right, "right", "left", spread_right)
    return cut.join(met, [*on, "_left_part", "_right_part"]).drop("_left_part", "_right_part")
