"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import cut_lineage

MOST_ROUNDS = 60


def _pull(links: DataFrame, both: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them, the node included.

    With ``both`` (large star) every node sees all neighbours and moves the
    larger ones; without (small star) it sees and moves the smaller ones.
    A node with very many neighbours is summed before the shuffle, and Spark
    splits its join.
    """
    seen = links.select(F.col("a").alias("n"), F.col("b").alias("m"))
    if both:
        seen = seen.unionByName(links.select(F.col("b").alias("n"), F.col("a").alias("m")))
    least = seen.groupBy("n").agg(F.min("m").alias("least")).select("n", F.least("n", "least").alias("least"))
    moved = seen.join(least, "n")
    if both:
        moved = moved.where(F.col("m") > F.col("n")).select(F.col("m").alias("a"), F.col("least").alias("b"))
    else:
        moved = moved.select(F.col("m").alias("a"), F.col("least").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("least").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b); the component is its smallest node.

    Every round cuts its lineage in the shared folder.  The rounds end when a
    round changes nothing; their number grows with the logarithm of the nodes.
    Null ends and loops are left out; repeated links count once.
    """
    now = cut_lineage(
        links.where((F.col("a") != F.col("b"))).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = None
    for _ in range(MOST_ROUNDS):
        now = cut_lineage(_pull(_pull(now, True), False))
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
