"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.base import counted


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node but the smallest of each component; edges have columns a and b (bigint).

    Every round writes its edges to the shared folder. A star step groups by node with minima only, summed in each task
    before the shuffle; the join back to edges splits a node with very many of them (skew join).
    """
    totals = [F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)]  # equal for equal sets of edges
    first = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, mark = counted(first, "stars", *totals)
    before = None
    while mark[0] and mark != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = mark
        now, mark = counted(rest.unionByName(low.withColumnRenamed("m", "v")).distinct(), "stars", *totals)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
