"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipward.llm.frames import stored

ROWS_PER_FILE = 1 << 16


def _few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many parts as ``rows`` rows need, at least one a core; never in more than it has."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, rows // ROWS_PER_FILE))


def _stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has only that one, and no larger one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"))
    )
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return per_node.where((F.col("up") > 0) & (F.col("n") > 1)).isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every linked node; the root is the least node of its component.

    Each round is a few joins on nodes and is written to the shared folder; a node with many links
    is one side of a join, never one group. Rounds grow with the logarithm of the longest chain and end
    when only stars are left. A round's files follow its rows, not the number of shuffle partitions.
    """
    edges = stored(
        links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u"))
        .where(F.col("u") != F.col("v"))
        .distinct(),
        "links",
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        edges = stored(_few_files(small, edges.count()), "links")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        roots.select("root").distinct().select(F.col("root").alias("node"), "root")
    )
