"""Connected components of an edge list by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _normal(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with u > v, once each."""
    return (
        edges.where("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours go to its smallest one."""
    both = edges.union(edges.select("v", "u"))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (u long, v long); label is the smallest node of the
    component, and the nodes that are a label are left out.

    Edges only ever shrink to stars. Each round is written to the shared folder, which cuts the
    lineage, and only a count and a checksum come back. Neighbours are combined by minimum before
    they are shuffled, and the joins can be split by adaptive execution, so a node with a third of
    all edges stays workable.
    """
    now, seen = written(_normal(edges), "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = mark
        now = written(_normal(_small_star(_normal(_large_star(now)))), "edges")
