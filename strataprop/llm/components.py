"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataprop.functions.runtime import fits_broadcast, stage
from strataprop.operators.joins import equi_join, find_hot_keys_of


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of an edge.

    ``edges`` has two columns ``a`` and ``b`` of one ordered type without nulls; order and
    repeats do not matter. Each round every node hangs itself under its smallest neighbour, and takes the
    one that this neighbour hangs under; edges are then drawn between the nodes so taken, until none is
    left. A round at least takes away every node with a smaller neighbour that is no one's smallest, and
    halves chains. Neighbours are only ever reduced to a minimum, so a node with very many of them is
    aggregated before the shuffle, and joins on it are spread. Each round is written to the shared folder.
    """
    left = stage(edges.select("a", "b").filter("a <> b").distinct())
    labels = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().withColumn("root", F.col("node"))
    while left.take(1):
        both = left.union(left.select("b", "a"))
        hung = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("up")))
        above = hung.select(F.col("node").alias("up"), F.col("up").alias("top"))
        taken = stage(equi_join(hung, above, "up", "inner").select("node", "top"))
        of_a, of_b = (taken.select(F.col("node").alias(x), F.col("top").alias(f"top_{x}")) for x in "ab")
        small = fits_broadcast(of_a)
        hot = {} if small else find_hot_keys_of(left, ["a", "b"])
        drawn = equi_join(left, of_a, "a", "inner", hot=hot.get("a"))
        drawn = equi_join(drawn, of_b, "b", "inner", hot=hot.get("b"))
        left = stage(drawn.filter("top_a <> top_b").select(
            F.col("top_a").alias("a"), F.col("top_b").alias("b")).distinct())
        labels = equi_join(labels if small else stage(labels), taken.withColumnRenamed("node", "root"), "root", "left").select(
            "node", F.coalesce("top", "root").alias("root"))
    return stage(labels)
