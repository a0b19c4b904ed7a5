"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthspark.llm.storage import Stage


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node of ``links`` (a, b) that has a link.

    Nodes are of one ordered type. Each step sends every node's larger (then
    smaller) neighbours to its smallest one, through aggregated minima and a
    join, so a node with very many links never meets them in one task. The
    number of steps grows with the logarithm of the longest path. Each step is
    written, so a lost executor costs no step again.
    """
    current = Stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "links")
    state = signature(current.df)
    while True:
        both = current.df.unionByName(current.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = Stage(both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .distinct(), "links")
        lower = large.df.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.df.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = Stage(lower.withColumnRenamed("m", "v").unionByName(moved).distinct(), "links")
        current.delete()
        large.delete()
        before, state, current = state, signature(small.df), small
        if state == before:
            break
    stars = current.df
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def signature(links: DataFrame) -> tuple[int, int]:
    """Number of links and a sum of their hashes: unchanged once every node points to its component's smallest."""
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)
